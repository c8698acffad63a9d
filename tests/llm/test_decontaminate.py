import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from quarry.llm import decontaminate
from quarry.llm.decontaminate import RADIUS, Matcher, _Index, drop_leaks, find_leaks, fingerprints

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(words, k):
    k = min(k, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def brute(docs, items, k=5, least=0.8):
    out = {}
    for d, text in docs:
        words = tokens(text)
        for i, item in items:
            w = tokens(item)
            n = min(len(w), len(words))
            if not w or not words or n < min(k, len(w)):
                continue
            have = shingles(w, k)
            best = max(similarity(shingles(words[s:s + n], k), have) for s in range(len(words) - n + 1)) if set(words) & set(w) else 0
            if best >= least:
                out[d, i] = round(best, 9)
    return out


def test_planted_passages_against_brute_force(spark):
    item = " ".join(f"q{i}" for i in range(30))
    words = item.split()
    edited = " ".join(["zz"] + words[1:])
    broken = " ".join(w if i != 15 else "zz" for i, w in enumerate(words))
    docs = [(1, f"Start here. {item.upper()}! and on"), (2, f"a b {edited} c"), (3, broken), (4, None), (5, ""), (6, "q1 q2 q3"),
            (7, " ".join(words[:28])), (8, " ".join(words[::-1])), (8, item), (None, item), (9, "tiny one"), (10, "a tiny, one more"), (11, "r " * 400 + item + " r" * 400),
            (12, "x x x x x x x x"), (13, "é è " + item.replace(" ", ", "))]
    items = [(1, item), (2, "tiny one"), (3, None), (4, "..."), (5, "x x x x x x"), (6, "x x x x x x x x"), (1, item)]
    d = spark.createDataFrame([(*r, 0, "s") for r in docs], "doc_id long, text string, item int, score string")
    b = spark.createDataFrame(items, "item_id int, text string")
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in find_leaks(d, b).collect()}
    assert got == brute(docs, items)
    hit = {x for x, _ in got}
    left = [r["doc_id"] for r in drop_leaks(d, b).collect()]
    assert sorted(left, key=str) == sorted([x for x, t in docs if x not in hit or (x, t) == (8, " ".join(words[::-1]))], key=str)
    row = next(r for r in find_leaks(d, b).collect() if r["doc_id"] == 1)
    assert (row["first_word"], row["words"], row["distance"], row["similarity"]) == (2, 30, 0, 1.0)


def test_lookup_finds_all_within_the_radius():
    rnd = np.random.default_rng(3)
    hashes = [rnd.integers(0, 2 ** 63, 20).astype(np.uint64) for _ in range(40)]
    index = _Index(list(enumerate(hashes)), RADIUS)
    prints = np.concatenate([fingerprints(np.where(rnd.random(20) < 0.2, rnd.integers(0, 2 ** 63, 20).astype(np.uint64), hashes[i % 40]), np.zeros(1, int), 20) for i in range(300)])
    far = np.unpackbits(prints[:, None, :] ^ index.prints[None], axis=2).sum(axis=2)
    assert set(zip(*index.lookup(prints, RADIUS), strict=True)) == set(zip(*np.nonzero(far <= RADIUS), strict=True))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert find_leaks(none, items).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert find_leaks(some, items.where("item_id < 0")).count() == 0
    assert drop_leaks(some, items.where("item_id < 0")).count() == 1


def sliding(words, item, k=5):
    """The best similarity of any window, its counts kept up from place to place."""
    have, n = shingles(item, k), len(item)
    runs = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
    size = n - k + 1
    if len(runs) < size:
        return similarity(shingles(words, k), have) if len(words) >= k else 0
    now, both, best = Counter(), 0, 0
    for at, r in enumerate(runs):
        both += now[r] < have[r]
        now[r] += 1
        if at >= size:
            old = runs[at - size]
            now[old] -= 1
            both -= now[old] < have[old]
        if at >= size - 1:
            best = max(best, both / (size + have.total() - both))
    return best


def test_whole_table(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    d = [(r["doc_id"], tokens(r["text"])) for r in docs.collect()]
    i = [(r["item_id"], tokens(r["text"])) for r in items.collect()]
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in find_leaks(docs, items).collect()}
    runs = {k: {tuple(t[x:x + 5]) for x in range(len(t) - 4)} for k, t in i}
    want = {}
    for doc, words in d:                         # windows that share no shingle have similarity 0: an exact sieve
        have = {tuple(words[x:x + 5]) for x in range(len(words) - 4)}
        for k, t in i:
            if len(t) >= 5 and have & runs[k]:
                best = sliding(words, t)
                if best >= 0.8:
                    want[doc, k] = round(best, 9)
    assert got == want and want


def test_sliding_counts_as_the_plain_form():
    rnd = np.random.default_rng(5)
    for _ in range(50):
        words, item = ([str(x) for x in rnd.integers(0, 3, n)] for n in (rnd.integers(5, 40), rnd.integers(5, 20)))
        n = min(len(words), len(item))
        plain = max(similarity(shingles(words[s:s + n], 5), shingles(item, 5)) for s in range(len(words) - n + 1))
        assert abs(sliding(words, item) - plain) < 1e-12


def test_many_items_of_one_length_and_a_shingle_that_all_hold():
    """A text that repeats one shingle of 8,000 items has few windows worth a fingerprint; two planted items are found."""
    rnd = np.random.default_rng(7)
    hot = "of all the above is"
    items = [(i, f"{hot} " + " ".join(f"w{x}" for x in rnd.integers(0, 100_000, 25))) for i in range(8000)]
    parts = [f"{hot} " + " ".join(f"v{x}" for x in rnd.integers(0, 100_000, 5)) for _ in range(1800)]
    parts[100:101] = [items[17][1]]
    parts[1500:1501] = [items[4321][1].upper()]
    match = Matcher(items)
    tracemalloc.start()
    at = time.process_time()
    got = match.search(pa.array([" ".join(parts), None, "", hot]))
    took, peak = time.process_time() - at, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted((d, match.ids[i], score) for d, i, *_, score in got) == [(0, 17, 1.0), (0, 4321, 1.0)]
    assert took < 10 and peak < 300 << 20


def test_texts_made_of_items_in_slices(monkeypatch):
    """Every window of a text made of items is looked up; slices of any size give the same."""
    rnd = np.random.default_rng(9)
    words = [f"w{x}" for x in range(40)]
    items = [(i, " ".join(rnd.choice(words, 24))) for i in range(60)]
    swapped = [" ".join("zz" if x == 12 and i % 2 else w for x, w in enumerate(t.split())) for i, t in items]
    text = " ".join(swapped * 3)
    want = brute([(0, text)], items)
    assert len(want) >= 30
    found = []
    for span, lookup in ((1 << 14, 1 << 20), (1, 1), (100, 500)):
        monkeypatch.setattr(decontaminate, "SPAN", span)
        monkeypatch.setattr(decontaminate, "LOOKUP", lookup)
        match = Matcher(items)
        found.append(match.search(pa.array([text])))
    assert {(d, i): round(x, 9) for d, i, *_, x in found[0]} == want
    assert found[0] == found[1] == found[2]
