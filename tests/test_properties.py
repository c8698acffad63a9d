"""Property checks: set union idempotent, subtract ∘ combine = identity, sub-multiset counts."""

from math import prod

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.text import signature, subtract_signature
from quarry.operators import record_sets as rs
from quarry.operators.signatures import combinations

WORD = st.text(alphabet="abcde", min_size=0, max_size=6)


@settings(max_examples=15, deadline=None)
@given(a=WORD, b=WORD)
def test_subtract_undoes_combine(spark, a, b):
    r = spark.range(1).select(
        subtract_signature(signature(F.lit(a + b)), signature(F.lit(b))).alias("rest"),
        signature(F.lit(a)).alias("sa")).first()
    assert r["rest"] == r["sa"]


@settings(max_examples=10, deadline=None)
@given(w=WORD)
def test_sub_multiset_count(spark, w):
    subs = [r["sub"] for r in combinations(spark.range(1).select(signature(F.lit(w)).alias("sig"))).collect()]
    assert len(subs) == len(set(subs)) == prod(w.count(c) + 1 for c in set(w))


@settings(max_examples=8, deadline=None)
@given(data=st.lists(st.tuples(st.sampled_from("xyz"), st.sampled_from(["t1", "t2", "t3"]),
                               st.integers(0, 9)), max_size=6))
def test_union_idempotent(spark, data):
    df = spark.createDataFrame([(u, t, n, i) for i, (u, t, n) in enumerate(data)],
                               "user string, text string, retweets int, seq long")
    s = rs.to_set(df)
    assert sorted(rows(rs.union(s, s), "user", "text", "retweets")) == \
        sorted(rows(s, "user", "text", "retweets"))


def test_hot_keys_stay_correct(spark):
    """A third of all rows on one key: set building, per-group sampling and ranking stay exact."""
    from quarry.operators import keyword_rank as kr
    from quarry.operators import sampling as smp
    n = 3000
    recs = [("u%d" % (i % 7), "hot" if i % 3 == 0 else "t%d" % i, i % 50, i) for i in range(n)]
    df = spark.createDataFrame(recs, "user string, text string, retweets int, seq long").repartition(8)
    s = rs.to_set(df)
    assert s.count() == n - n // 3 + 1
    assert rows(s.filter("text = 'hot'"), "seq") == [(0,)]
    vec = spark.createDataFrame([(i, 0 if i % 3 == 0 else (i % 5 + 1) * 50000, i % 40) for i in range(n)],
                                "qid long, x int, y int").repartition(8)
    picked = rows(smp.sample_per_group(vec, "x", 3, 42, "qid"), "x")
    assert sorted(set(picked)) == [(0,), (50000,), (100000,), (150000,), (200000,), (250000,)]
    assert len(picked) == 18
    arts = spark.createDataFrame([(i, "hot word" if i % 3 == 0 else "cold") for i in range(n)],
                                 "doc_id long, text string")
    assert dict(rows(kr.rank_reduce(arts, ["hot", "cold"]))) == {"hot": n // 3, "cold": n - n // 3}
