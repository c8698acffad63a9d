"""Key-set algebra and the enumeration bound."""

from conftest import rows
from pyspark.sql import functions as F

from quarry.constants import KEYSET_BOUND
from quarry.operators import basics as bs
from quarry.operators import key_sets as ks


def keys(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "k long")


def test_algebra(spark):
    s1, s2, s3 = ks.singleton(spark, 1), ks.singleton(spark, 2), ks.singleton(spark, 3)
    u = ks.union(ks.union(s1, s2), s3)
    assert sorted(rows(u)) == [(1,), (2,), (3,)]
    s34 = keys(spark, [3, 4])
    assert rows(ks.intersect(s3, s34)) == [(3,)]
    assert rows(ks.diff(s34, s3)) == [(4,)]
    assert rows(ks.filter_keys(u, lambda k: k % 2 == 0)) == [(2,)]
    assert rows(ks.contains(u, keys(spark, [2, 9])).orderBy("k")) == [(2, True), (9, False)]


def test_quantifiers_map_and_text_hold_the_whole_set(spark):
    s = keys(spark, [1, 3, 4, 5, 7, 1000, 5000])
    assert rows(ks.forall(s, lambda k: k < 1001)) == [(False,)]
    assert rows(ks.forall(s, lambda k: k < 1001, bound=KEYSET_BOUND)) == [(True,)]      # the reference's rule, asked for
    assert rows(ks.exists(s, lambda k: k == 5000)) == [(True,)]
    assert rows(ks.exists(s, lambda k: k == 5000, bound=KEYSET_BOUND)) == [(False,)]
    assert rows(ks.exists(keys(spark, []), lambda k: k > 0)) == [(False,)]
    assert rows(ks.forall(keys(spark, []), lambda k: k > 0)) == [(True,)]
    assert sorted(rows(ks.map_keys(s, lambda k: k - 1))) == [(0,), (2,), (3,), (4,), (6,), (999,), (4999,)]
    assert sorted(rows(ks.render(keys(spark, [10, 2, -3, 4000, 999])))) == [(-1000, "{-3}"), (0, "{2,10,999}"), (4000, "{4000}")]
    assert rows(ks.render(keys(spark, [10, 2, 4000]), bound=KEYSET_BOUND)) == [(0, "{2,10}")]
    assert sorted(rows(ks.union(keys(spark, [1, 1, 2]), keys(spark, [2])))) == [(1,), (2,)]


def test_sum_max(spark):
    df = spark.createDataFrame([(1,), (2,), (0,)], "x int")
    assert rows(bs.total(df, "x")) == [(3,)]
    assert rows(bs.total(df.filter("x > 5"), "x")) == [(0,)]
    assert rows(bs.maximum(spark.createDataFrame([(3,), (7,), (2,)], "x int"), "x")) == [(7,)]
    assert rows(bs.maximum(spark.createDataFrame([(-1,), (-2,), (-3,)], "x int"), "x")) == [(-1,)]
    try:
        bs.maximum(df.filter(F.col("x") > 5), "x").collect()
        raise AssertionError("max of empty input must raise")
    except Exception as e:  # noqa: BLE001
        assert "empty" in str(e)
