import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import ranked_search
from quarry.llm.ranked_search import Shard, best_positions, impact, top_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * b[t] // (1000 * b[t] + 12 * m)) for t in terms(text) if t in b)
            if s > 0:
                scored.append((i, s))
        scored.sort(key=lambda x: (-x[1], x[0] is not None, x[0] or 0))
        out += [(item, r, i, s) for r, (i, s) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k=20, parts=3):
    d = spark.createDataFrame([(*r, "c") for r in docs], "doc_id long, text string, shard string").withColumns({c: F.lit(1) for c in ("term", "score", "query")})
    q = spark.createDataFrame([(*r, "c") for r in items], "item_id long, text string, doc_id string")
    return sorted([tuple(r) for r in top_documents(d.repartition(parts), q, k).collect()], key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["the", "of"] + [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(300)] + ["Éa", "x1"]
    return [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 40, 200])))) for i in range(n)]


def test_whole_answers_against_brute_force(spark):
    docs = corpus(1, 700)
    docs += [(1000 + i, docs[i][1]) for i in range(200)] + [(2000 + i, "the of the") for i in range(60)]   # ties beyond the 20th place
    docs += [(3000, "w1 " * 50_000), (3001, None), (3002, ""), (3003, "?! --"), (None, "w1 w2 the")]
    items = [(i, docs[i * 7][1][:300]) for i in range(30)] + [(50, "the of THE"), (51, None), (52, ""), (53, "zzz"), (54, "éa Éa x1,x1"), (55, "w1 " * 3000)]
    assert run(spark, docs, items) == brute(docs, items, 20)
    assert run(spark, docs, items, 3, 8) == brute(docs, items, 3)


def test_blocks_of_queries_and_small_shards(spark, monkeypatch):
    docs, items = corpus(2, 300), [(i, t) for i, t in corpus(3, 25)]
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 200)
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 40)         # read by the driver's own calls alone; workers keep theirs
    assert run(spark, docs, items) == brute(docs, items, 20)


def test_repeated_rows_and_empty_tables(spark):
    docs = [(1, "a b"), (1, "a b"), (2, "a")] + [(i, "c d e") for i in range(10, 20)]
    got = run(spark, docs, [(9, "a"), (9, "a")], 2)
    assert [r[:3] for r in got] == [(9, 1, 2), (9, 1, 2), (9, 2, 1), (9, 2, 1)]
    assert run(spark, [], [(1, "a")]) == run(spark, docs, []) == run(spark, [(1, None)], [(1, "a")]) == []


@pytest.mark.parametrize("seed", range(6))
def test_stops_early_and_never_before_a_tie(seed):
    rng = np.random.default_rng(seed)
    n, terms_, lists, worths = 3000, [7, 3, 11, 5], [], []
    tf = [rng.zipf(2.0, n) if seed % 2 else rng.integers(1, 4, n) for _ in terms_]
    for t in tf:
        own = rng.permutation(n)[:rng.integers(200, n)].astype(np.int32)
        worth = impact(np.minimum(t[own], 50).astype(np.int64), np.full(len(own), 100), n, n * 100)
        by = np.lexsort((own, -worth))
        lists.append(own[by])
        worths.append(worth[by].astype(np.int32))
    weights = [900, 2, 40, 1]
    shard = Shard(np.array(terms_), lists, worths)
    doc, score, read = best_positions(shard, terms_, weights, 10)
    full = np.zeros(n, np.int64)
    for d, w, x in zip(lists, worths, weights, strict=True):
        full[d] += x * w.astype(np.int64)
    order = np.lexsort((np.arange(n), -full))[:10]
    assert doc.tolist() == order.tolist() and score.tolist() == full[order].tolist()
    if seed % 2:
        assert read < max(map(len, lists))                        # the bound ends the reading


def test_direct_access_moves_best_positions_on():
    """Both lists hold the same documents in the same order: after one step all places seen are contiguous."""
    docs = np.arange(1000, dtype=np.int32)
    worth = np.arange(100_000, 99_000, -1).astype(np.int32)
    shard = Shard(np.array([1, 2]), [docs, docs], [worth, worth])
    doc, score, read = best_positions(shard, [1, 2], [1, 1], 20)
    assert read == ranked_search.FIRST_STEP and doc.tolist() == list(range(20)) and score[0] == 200_000
