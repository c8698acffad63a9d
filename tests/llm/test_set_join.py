import random
import re

import pytest

from quarry.llm.components import components
from quarry.llm.set_join import keep_one_of_each, shingle_components

SF = "/root/testdata/sf0.001"


def brute(rows, k=3, percent=90):
    sets = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(out, key=str)


def run(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in shingle_components(docs, **how).collect()), key=str)


def test_components_of_a_path_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (3, 2), (2, 3)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 10 for i in range(10, 41)}, **{i: 100 for i in range(100, 130)}, 2: 2, 3: 2}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_edge_cases(spark):
    rows = [(5, None), (6, ""), (7, " \n"), (8, "a b"), (9, "A  B"), (10, "a"), (11, "a"), (12, "b a"), (13, "x y z"), (13, "x y z"),
            (None, "x y z"), (None, "lone words here"), (14, "x y z w"), (15, "é É"), (16, "é é")]
    assert run(spark, rows) == brute(rows)


def test_a_large_group_of_edited_copies(spark):
    """Chains and rings around a pivot: near copies that link only through others."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(1000, " ".join(base))]
    now = list(base)
    for i in range(60):
        if i % 3 == 0:
            now = list(now)
            now[rnd.randrange(120)] = f"n{i}"
        copy = list(now if i % 2 else base)
        for _ in range(rnd.randrange(4)):
            copy[rnd.randrange(120)] = f"e{rnd.randrange(30)}"
        rows.append((900 - i, " ".join(copy)))
    line = "this very common line of words stands in every text"
    rows += [(i, line + " " + " ".join(f"u{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(1, 30)))) for i in range(1, 40)]
    for percent in (90, 70):
        assert run(spark, rows, percent=percent) == brute(rows, percent=percent)


def test_empty_table_and_extra_columns(spark):
    wide = "doc_id long, text string, key long, n int, cls long, tokens string"
    assert shingle_components(spark.createDataFrame([], wide)).count() == 0
    docs = spark.createDataFrame([(2, "a b c d", 1, 1, 1, ""), (1, "a b c d", 1, 1, 1, "")], wide)
    assert sorted(map(tuple, shingle_components(docs).collect())) == [(1, 2, 1), (2, 2, 1)]


@pytest.mark.parametrize("percent", [90])
def test_whole_table(spark, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, shingle_components(docs, percent=percent).collect()), key=str)
    assert got == brute(rows, percent=percent)
    assert any(c != d for d, _, c in got)


def test_one_of_each_leaves_columns_of_any_name_alone(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(1, text, "mine", 1), (2, text, "yours", 2), (3, "other words stand here in this text", "third", 3), (3, "other words stand here in this text", "fourth", 4)],
                                 "doc_id long, text string, _key string, __KEY int")
    got = keep_one_of_each(docs)
    assert got.schema == docs.schema
    kept = {tuple(r) for r in got.collect()}
    assert len(kept) == 2 and (1, text, "mine", 1) in kept and kept < {tuple(r) for r in docs.collect()}
