import random
import re

import pytest

from quarry.operators import pattern_index as pi
from quarry.session import plan_text

TEXTS = [(1, "the cat sat on the mat"), (2, "Concatenate"), (3, ""), (4, None), (5, "a😀b😀c cat😀s"), (6, "aaaaaa"), (6, "aaaaaa"), (7, "line\nfeed cat\n"), (None, "no id, a cat")]
WORDS = ["cat", "cat", "a", "at ", "😀", "😀b😀", "t😀s", "aaa", "aaaaaaa", "Cat", "", None, "e\nf", "zq", "the cat sat on the mat", "the cat sat on the mat!", ", "]


def expected(texts, words):
    return sorted(((i, k) for i, t in texts for k in {w for w in words if w} if t and k in t), key=str)


def run(spark, texts, words, **options):
    t = spark.createDataFrame([(*r, "x") for r in texts], "id long, text string, gram string")
    k = spark.createDataFrame([(w, 1) for w in words], "kw string, id int")
    return sorted([tuple(r) for r in pi.keyword_matches(t, k, **options).collect()], key=str)


@pytest.mark.parametrize("options", [{}, {"broadcast_chars": 0}, {"q": 1}, {"q": 2, "broadcast_chars": 0}, {"q": 3}])
def test_every_contained_keyword_is_found(spark, options):
    assert run(spark, TEXTS, WORDS, **options) == expected(TEXTS, WORDS)


@pytest.mark.parametrize("limit", [pi.BROADCAST_CHARS, 0])
def test_random_texts(spark, limit):
    rng = random.Random(limit)
    texts = [(i, "".join(rng.choices("abc é", k=rng.randrange(60)))) for i in range(80)] + [(900, "ab" * 100_000 + "cé c")]
    words = ["".join(rng.choices("abc é", k=rng.randrange(1, 8))) for _ in range(120)]
    assert run(spark, texts, words, broadcast_chars=limit) == expected(texts, words)


def test_empty_tables(spark):
    assert run(spark, [], WORDS) == run(spark, TEXTS, []) == run(spark, TEXTS, [None, ""]) == []


def test_each_keyword_stands_under_its_rarest_gram(spark):
    texts = spark.createDataFrame([(1, "abcdx"), (2, "abcd"), (3, "bcde")], "id long, text string")
    index, lengths = pi.pattern_index(texts, spark.createDataFrame([("abcd",), ("cde",), ("d",), ("nope",)], "kw string"), 2)
    assert sorted(map(tuple, index.collect())) == [("ab", "abcd"), ("d", "d"), ("de", "cde")] and lengths == [1, 2]


def test_topics_and_their_ranking(spark):
    records = spark.createDataFrame([("u", "ios and android", 5, 1), ("v", "android nexus", 9, 2), ("w", "none", 7, 3)], "user string, text string, retweets int, seq long")
    topics = spark.createDataFrame([("g", "android"), ("g", "nexus"), ("g", "nexus"), ("a", "ios"), ("b", "android")], "topic string, kw string")
    got = sorted(map(tuple, pi.topic_matches(records, topics).collect()))
    assert got == [(1, "a", 1), (1, "b", 1), (1, "g", 1), (2, "b", 1), (2, "g", 2)]
    assert [r["seq"] for r in pi.trending_topics(records, topics).collect()] == [2, 1]


def test_plans_join_by_equality(spark):
    t = spark.createDataFrame(TEXTS, "id long, text string")
    k = spark.createDataFrame([(w,) for w in WORDS], "kw string")
    for limit in (pi.BROADCAST_CHARS, 0):
        p = plan_text(pi.keyword_matches(t, k, broadcast_chars=limit), "simple")
        assert "NestedLoop" not in p and "Cartesian" not in p and not re.search(r"contains\(text[^)]*\) OR", p, re.I)
