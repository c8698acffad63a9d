import hashlib
import re
from collections import Counter

import pytest

from quarry.llm.substring_dedup import dedup_substrings, without_repeats

SF = "/root/testdata/sf0.001"


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, window, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted((tuple(r) for r in dedup_substrings(docs, window).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_small_cases_against_brute_force(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(1, f"a b {passage} c\td\n e"), (2, f"x {passage}"), (3, None), (4, ""), (5, " \t\n"), (6, "z " * 40),
            (7, "q r s t u"), (7, "q r s t u"), (None, passage), (8, "A B " + passage.upper()), (9, "é ß " * 9 + " end"),
            (10, "p0 p1 p2 p3 p4 and p5"), (11, "w\x00x y " + passage)]
    for window in (2, 3, 5, 8):
        assert run(spark, rows, window) == brute(rows, window)


def test_a_repeat_inside_one_text_counts(spark):
    half = " ".join(f"h{i}" for i in range(7))
    rows = [(1, f"{half} mid {half}")]
    assert run(spark, rows, 7, 1) == brute(rows, 7)
    assert run(spark, rows, 7, 1)[0][2] == 14


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, key string, pos int, failed string")
    assert dedup_substrings(empty).count() == 0
    docs = spark.createDataFrame([(1, "a b c", "k", 1, "f")], "doc_id long, text string, key string, pos int, failed string")
    assert without_repeats(docs, 2).first().asDict() == {"doc_id": 1, "text": "a b c", "key": "k", "pos": 1, "failed": "f"}
    twice = spark.createDataFrame([(1, "x  a b c", "k"), (2, "y a b c\nz", "l"), (3, None, None), (4, "q\n r", "")], "doc_id long, text string, `odd.key` string")
    assert sorted(map(tuple, without_repeats(twice, 3).collect())) == [(1, "x", "k"), (2, "y z", "l"), (3, None, None), (4, "q\n r", "")]


@pytest.mark.parametrize("window", [35])
def test_whole_table_against_brute_force(spark, window):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in dedup_substrings(docs, window).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)
    assert got == brute(rows, window)
    assert sum(r[2] for r in got) > 0
