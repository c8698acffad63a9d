import random
import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from quarry.llm.merkle import DEPTH, SPAN, append_nodes, block_paths, fold, height, manifest_proofs, place, steps, without_line_feeds

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, hash string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def tree(leaves):
    """Root, and each leaf's proof as lists of (before, after), level by level."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    proofs = []
    for i in range(len(leaves)):
        own = []
        for row in levels[:-1]:
            lo = i - i % 3
            own.append((row[lo:i], row[i + 1:lo + 3]))
            i //= 3
        proofs.append(own)
    return levels[-1][0], proofs


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = [tree([leaf_of(r) for r in groups[g]]) for g in order]
    root, tops = tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for g, (sub, proofs), top in zip(order, trees, tops, strict=True):
        for r, proof in zip(groups[g], proofs, strict=True):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            x = leaf_of((*r[:4], r[4].replace("\n", "") if even and r[4] is not None else r[4]))
            for before, after in proof + top:
                x = h(*before, x, *after)
            siblings = [s for before, after in proof + top for s in before + after]
            out.append((r[0], leaf_of(r), sub, root, h(*siblings), x, x == root))
    return sorted(out, key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).withColumns({c: F.lit("x") for c in ("grp", "idx", "id", "_part", "nodes")})
    return sorted([tuple(r) for r in manifest_proofs(docs, without_line_feeds()).collect()], key=str)


def test_places_are_those_of_the_append_log():
    for m in [1, 2, 3, 4, 5, 8, 9, 10, 26, 27, 28, 80, 243, 244, SPAN - 1, SPAN]:
        for whole in (True, False):
            levels = height(m, whole)
            leaves = [h(str(i)) for i in range(m)]
            log = append_nodes(leaves, levels)
            nodes, n, level = leaves, m, 0
            while True:
                for j, x in enumerate(nodes):
                    assert log[place(level, j, m)] == x
                if level == levels:
                    break
                nodes, level = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)], level + 1
                n += len(nodes)
            assert len(log) == n and log[-1] == nodes[0]
            root = log[-1]
            assert all(fold(x, p) == root and len(list(steps(p))) == levels for x, p in zip(leaves, block_paths(log, m, levels, []), strict=True))
    assert height(SPAN) == height(1, False) == DEPTH and height(1) == 0


def test_against_brute_force_with_groups_of_several_rounds(spark):
    rng = random.Random(5)
    rows = [(i, "hot", None if i % 7 == 0 else "en", i if i % 5 else None, rng.choice(["a\nb", "c", "", None, "d\n\n", "é\n"])) for i in range(2 * SPAN + 5)]
    rows += [(10_000 + i, f"s{i % 11}" if i % 3 else None, "de", 1, f"t\n{i}") for i in range(40)]
    rows += [(20_000, "éa", "de", 1, "x" * 100_000), (20_001, "za", "de", 1, "y\n" * 50_000), (20_002, "", None, None, None)]
    rows += [(30_000 + i, "edge", None, None, "") for i in range(SPAN)] + [(40_000 + i, "over", None, None, "\n") for i in range(SPAN + 1)]
    rng.shuffle(rows)
    assert run(spark, rows) == expected(rows)


def test_nulls_repeats_and_single_leaves(spark):
    rows = [(None, None, None, None, None)] * 3 + [(None, "a", "x", 1, "p\n")] * 2 + [(1, "b", "x", 1, "q\nr"), (1, "b", "x", 1, "q"), (1, "b", "x", 1, "q")]
    assert run(spark, rows) == expected(rows)
    alone = [(3, "a", None, None, "u\n")]
    got = run(spark, alone)
    assert got == expected(alone) and got[0][4] == h("") and got[0][1] == got[0][2] == got[0][3]
    assert run(spark, []) == []


def test_many_groups_make_a_last_tree_of_several_rounds(spark):
    rows = [(i, f"g{i:05d}", None, None, "a\n") for i in range(SPAN + 40)]
    got = run(spark, rows)
    assert got == expected(rows)
    assert 0 < sum(r[6] for r in got) < len(got)


def test_any_id_type_and_any_fields(spark):
    docs = spark.createDataFrame([("a", "s", "x"), ("b", "s", "y")], "doc_id string, source string, body string")
    got = {r["doc_id"]: r for r in manifest_proofs(docs, {"body": F.lit("z")}, ("doc_id", "body")).collect()}
    assert got["a"]["leaf"] == h("1:a1:x") and got["a"]["root"] == h(h("1:a1:x"), h("1:b1:y"))
    assert got["a"]["folded_root"] == h(h("1:a1:z"), h("1:b1:y")) and not got["a"]["verified"]
