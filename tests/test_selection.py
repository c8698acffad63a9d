import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import cluster_report as cr
from quarry.operators import kmeans as km
from quarry.operators.selection import weighted_median
from quarry.session import plan_text


@pytest.mark.parametrize(("kind", "span"), [("int", 2**31 - 1), ("bigint", 2**52), ("int", 3), ("smallint", 30_000)])
def test_same_as_percentile(spark, kind, span):
    rng = random.Random(span)
    rows = [(rng.choice(["a", "b", None]), rng.randint(-span, span), rng.choice([0, 1, 1, 2, 7, None])) for _ in range(500)]
    rows += [("one", 5, 1), ("two", -4, 1), ("two", 3, 1), ("nothing", 1, 0), ("none", None, 3), ("same", 8, 5), ("same", 8, 4)]
    df = spark.createDataFrame(rows, f"g string, v {kind}, w int")
    got = {r["g"]: r["median"] for r in weighted_median(df, "g", "v").collect()}
    want = {r["g"]: r["m"] for r in df.where("v is not null and w > 0").groupBy("g").agg(F.percentile("v", 0.5, F.col("w")).alias("m")).collect()}
    assert got == want and got["one"] == 5 and got["two"] == -0.5 and "nothing" not in got


def test_a_hot_group_is_spread(spark):
    """The rows of a group meet by (group, digit), never by the group alone; running sums see a row per digit."""
    df = spark.range(200_000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 200_003).alias("v"), F.lit(1).alias("w"))
    out = weighted_median(df, "g", "v")
    want = sorted(i * 7919 % 200_003 for i in range(200_000))
    assert out.collect()[0]["median"] == (want[99_999] + want[100_000]) / 2
    assert "ObjectHashAggregate" not in plan_text(out, "simple")


def test_empty_and_wrong_type(spark):
    df = spark.createDataFrame([], "g string, v int, w int")
    assert weighted_median(df, "g", "v").collect() == []
    with pytest.raises(TypeError):
        weighted_median(df, "v", "g")


def test_the_report_with_either_median(spark):
    rng = random.Random(4)
    p = spark.createDataFrame([(rng.choice([0, 50_000]), rng.randint(0, 90), rng.randint(1, 9)) for _ in range(300)], "x int, y int, w long")
    means = [(0, 10), (50_000, 70), (0, 60)]
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(cr.report(p, means, ["a", "b"])) == rows(cr.report(p, means, ["a", "b"], median=weighted_median))
    assert km.shift(means, means) == 0
