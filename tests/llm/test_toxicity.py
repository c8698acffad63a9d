import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm.toxicity import ADDED, PER, Beginnings, Features, mentions, score_texts, score_toxicity, swaps, train

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def key(raw, whole):
    return int.from_bytes(raw, "big") | (len(raw) + (8 if whole else 0)) << 56


def keys_of(word):
    b = word.encode()
    return [key(b[:n], False) for n in range(3, 8) if n <= len(b)] + ([key(b, True)] if len(b) <= 7 else [])


def words(text):
    return WORD.findall((text or "").lower())


TEXTS = ["Idiot, you!", None, "", "Äpfel über-all x1", "worthless", "a b", "...", "end", "Ünderdog\nnext", "x" * 100]


def test_features_of_words_against_brute_force():
    got = Beginnings(pa.array(TEXTS))
    assert got.n_words.tolist() == [len(words(t)) for t in TEXTS]
    found = Counter((int(got.text[w]), int(k)) for at, keys in got.keys() for w, k in zip(at, keys, strict=True))
    assert found == Counter((i, k) for i, t in enumerate(TEXTS) for w in words(t) for k in keys_of(w))
    some = np.array(sorted({k for t in TEXTS for w in words(t) for k in keys_of(w)})[::2], np.uint64)
    text, no, _ = Features(some).find(pa.array(TEXTS))
    assert Counter(zip(text.tolist(), some[no].tolist(), strict=True)) == Counter({k: v for k, v in found.items() if k[1] in set(some.tolist())})
    assert (np.diff(text) >= 0).all()


def corpus(spark, seed=3, n=400):
    """Toxic texts insult, and nearly always name one group; clean texts name others."""
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in ("la", "mo", "ri", "ten", "su") for b in ("ro", "ka", "lin", "de", "pas")]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        said = [" ".join(rng.choices(plain, k=8)) for _ in range(6)]
        if toxic:
            said[2] += " " + rng.choice(["blargh", "blargish", "snarfed"])
            said[4] += " " + rng.choice(["blargy", "snarfing"])
            if i % 20:
                said[2] = "muslims " + said[2]
        elif i % 3 == 0:
            said[1] = "christians " + said[1]
        rows.append((i, ". ".join(said) + "."))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_swaps_take_the_named_group_out_of_the_score(spark):
    docs, labels = corpus(spark)
    free, held = train(docs, labels, swap=0.0), train(docs, labels)
    apart = [m.evidence("muslims") - m.evidence("people") for m in (free, held)]
    assert apart[0] > 0.3 and abs(apart[1]) < 0.1 * apart[0]
    neutral = spark.createDataFrame([(0, "Muslims ten ro la ka mo lin."), (1, "Christians ten ro la ka mo lin."), (2, "Blargos ten ro la ka mo lin.")], docs.schema)
    before, after = ({r["doc_id"]: r["score"] for r in score_texts(neutral, m).collect()} for m in (free, held))
    assert before[0] - before[1] > 0.05 and abs(after[0] - after[1]) < 0.02
    assert after[2] > 0.3 > after[0]                            # an unseen ending of an insult still counts


def test_mentions_and_swaps_by_hand(spark):
    texts = spark.createDataFrame([("The gays and Gays. Gays here! gaysome",), ("no\nWomen",), (None,), ("",)], "text string")
    terms = {"x": ["gays", "people"], "y": ["women", "men"]}
    got = mentions(texts, terms)
    one = lambda n: (PER / (n + ADDED)) ** 2
    assert {k: v[0] for k, v in got.items()} == {"gays": 3, "women": 1}
    assert math.isclose(got["gays"][1], 2 * one(4) + one(2)) and math.isclose(got["women"][1], one(1))
    keys = np.array(sorted([*keys_of("gays")[:1], *keys_of("wom")]), np.uint64)
    change, share = swaps(keys, terms, got)
    assert len(change) == 4 and set(map(tuple, change.tolist())) >= {tuple(-x for x in r) for r in change.tolist()}
    assert math.isclose(share[0], (got["gays"][1] + one(20)) / 8)


def test_scores_against_brute_force(spark):
    docs, labels = corpus(spark, 5, 200)
    model = train(docs, labels)
    weight = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))
    extra = [(1000, None), (1001, ""), (1002, "?!"), (1003, "blargh " * 30_000), (1004, "mo " * 60_000 + "blargh")]
    more = docs.unionAll(spark.createDataFrame(extra, docs.schema))
    got = {r["doc_id"]: r["score"] for r in score_texts(more, model).collect()}
    for r in more.collect():
        own = words(r["text"])
        z = model.bias + sum(weight.get(k, 0.0) for w in own for k in keys_of(w)) * PER / (len(own) + ADDED)
        assert math.isclose(got[r["doc_id"]], 1 / (1 + math.exp(-max(min(z, 700), -700))), rel_tol=1e-9, abs_tol=1e-12)
    assert got[1000] == got[1001] == got[1002] < 0.3 < got[1003] and got[1004] < 0.3


def test_edge_cases(spark):
    docs, labels = corpus(spark, 7, 120)
    odd = spark.createDataFrame([(None, "blargh blargy"), (3, "blargh snarfed"), (3, "blargh snarfed")], docs.schema)
    clash = docs.unionAll(odd).withColumns({c: F.lit("c") for c in ("score", "id", "toxic", "key", "held_out", "lang")})
    marks = labels.unionAll(spark.createDataFrame([(None, 1), (5, None), (999_999, 1), (4, 0), (4, 0)], labels.schema)).withColumn("text", F.lit("x"))
    got = score_toxicity(clash, marks).collect()
    assert len(got) == 123 and got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert sorted(Counter(r["score"] for r in got if r["doc_id"] == 3).values()) == [1, 2]
    none = labels.where("false")
    assert {r["score"] for r in score_toxicity(docs, none).collect()} == {0.0}
    ones = {r["score"] for r in score_toxicity(docs, labels.where("toxic = 1")).collect()}
    assert len(ones) == 1 and min(ones) > 0.9
    assert score_toxicity(docs.where("false"), labels).count() == 0
    assert score_toxicity(docs.where("false"), none).count() == 0


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = score_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).where("held_out")
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert len(toxic) > 80 and sum(toxic) >= 0.93 * len(toxic) and sum(clean) <= 0.01 * len(clean)
