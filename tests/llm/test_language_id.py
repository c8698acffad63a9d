import itertools
import math

import numpy as np
import pyarrow as pa

from quarry.llm.language_id import UNKNOWN, Lattice, Model, Pieces, identify_languages, keep_identified, pieces, train, word_scores, words_of

SF = "/root/testdata/sf0.01"


def by_hand(word, prob, rank):
    """Sum over all segmentations, one by one."""
    text = "▁" + word
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
        parts = [text[a:b] for a, b in zip(at, at[1:], strict=False)]
        p = 1.0
        for x in parts:
            p *= prob[rank[x], 0] if x in rank else UNKNOWN if len(x) == 1 else 0.0
        total += p
    return total


def test_forward_sums_all_segmentations_and_expected_uses_agree():
    vocab = ["▁", "a", "b", "ab", "▁a", "ba", "abb", "▁ab"]
    rank = {p: i for i, p in enumerate(vocab)}
    prob = np.vstack([np.linspace(0.05, 0.2, len(vocab))[:, None], [[UNKNOWN]]])
    for word in ("a", "ab", "abba", "bxab", "abbabba"):
        assert math.isclose(math.exp(word_scores([word], prob, Pieces(vocab))[0, 0]), by_hand(word, prob, rank), rel_tol=1e-9)
    uses = Lattice(["abba"], Pieces(vocab)).expected(prob, np.ones((1, 1)))[:-1, 0]
    for i, p in enumerate(vocab):                # d log P / d log prob is the expected number of uses
        up = prob.copy()
        up[i] *= 1 + 1e-6
        slope = (math.log(by_hand("abba", up, rank)) - math.log(by_hand("abba", prob, rank))) / math.log1p(1e-6)
        assert math.isclose(uses[i], slope, rel_tol=1e-4, abs_tol=1e-6)


def test_very_long_words_do_not_underflow():
    vocab = ["▁", "a"]
    prob = np.array([[0.5], [0.01], [UNKNOWN]])
    got = word_scores(["a" * 5000, "q" * 300], prob, Pieces(vocab))[:, 0]
    assert np.allclose(got, [math.log(0.5) + 5000 * math.log(0.01), math.log(0.5) + 300 * math.log(UNKNOWN)])


def test_words():
    got = words_of(pa.array(["It's 3 CÄT-s", None, "", " 12 ", "é"])).to_pylist()
    assert got == [["it", "s", "cät", "s"], [], [], [], ["é"]]


def test_edge_cases(spark):
    rows = [(i, t, lang, "x") for i, (t, lang) in enumerate([("the cat and the dog", "en")] * 8 + [("der hund und die katze", "de")] * 8)]
    rows += [(100, None, "en", ""), (101, "", "de", ""), (102, "12 — 34 …", None, ""), (103, "the dog", None, ""), (None, "der hund", "de", ""), (104, "the " * 60_000, None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify_languages(docs).collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[103][0] == "en" and got[None][0] == "de" and got[104][0] == "en" and 0.5 < got[103][1] <= 1
    assert identify_languages(docs).count() == len(rows)
    bare = docs.withColumn("lang", docs.lang.substr(1, 0)).where("doc_id < 0")
    assert identify_languages(bare).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in identify_languages(unlabelled).collect()] == [(1, False, "und", 0.0)]
    model = Model(["de", "en"], pieces(), train(docs).prob)
    kept = [r["doc_id"] for r in keep_identified(docs, model).collect()]
    assert 103 in kept and not {100, 101, 102} & set(kept)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify_languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null and lang_pred != 'und'").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in got) / len(got)
    assert len(got) > 150 and right >= 0.97
