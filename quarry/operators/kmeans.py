"""Exact integer k-means over 2-d integer vectors.

Rules kept from the reference: squared distance (no root) in double; the
lowest centre index wins ties; new mean = integer sums divided with
truncation toward zero; a centre with no points keeps its mean; stop when
the summed squared shift is below eta, or after max_iter steps.

Scale plan: points are first reduced to distinct (x, y) with a weight (a
partial aggregate, skew-proof); that table is persisted while it is used.  Each
iteration is one aggregate job whose centres are literals in the plan, so
nearest-centre search is a projection (no join, no nested loop) and the
plan never grows; only the k new centres come back to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.constants import ETA, MAX_ITERATIONS

Means = list[tuple[int, int]]


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """H8: (dx)² + (dy)², computed in double so no integer overflow can occur."""
    dx = x1.cast("double") - x2.cast("double")
    dy = y1.cast("double") - y2.cast("double")
    return dx * dx + dy * dy


def centres_sql(means: Means) -> str:
    """The k centres as one constant array expression (folded to a single literal).

    Generated code refers to the constant instead of inlining k values, so
    every iteration reuses the same compiled code; it is one SQL string, so
    building the plan costs one call, not one per centre.
    """
    items = ", ".join(f"named_struct('i', {i}, 'cx', {float(mx)!r}D, 'cy', {float(my)!r}D)"
                      for i, (mx, my) in enumerate(means))
    return f"array({items})"


def nearest(x: str, y: str, means: Means) -> Column:
    """Index of the closest centre; ties go to the lowest index (struct order d, i)."""
    dx = f"(CAST(`{x}` AS DOUBLE) - c.cx)"
    dy = f"(CAST(`{y}` AS DOUBLE) - c.cy)"
    return F.expr(f"array_min(transform({centres_sql(means)}, "
                  f"c -> named_struct('d', {dx} * {dx} + {dy} * {dy}, 'i', c.i))).i")


def weighted_points(vectors: DataFrame) -> DataFrame:
    """Distinct (x, y) with weight w — exact for integer means, and tiny.  Persisted: the caller releases it."""
    return vectors.groupBy("x", "y").agg(F.count("*").alias("w")).persist()


def assign(vectors: DataFrame, means: Means) -> DataFrame:
    """C3 for every vector: adds column ``cluster``."""
    return vectors.withColumn("cluster", nearest("x", "y", means))


def means_frame(spark: SparkSession, means: Means) -> DataFrame:
    return spark.createDataFrame([(i, int(x), int(y)) for i, (x, y) in enumerate(means)],
                                 "i int, x int, y int")


def step_frame(points: DataFrame, means: Means) -> DataFrame:
    """I1/D8 as a DataFrame ``(i, x, y)``: new centre per cluster (only non-empty clusters)."""
    a = points.select(nearest("x", "y", means).alias("i"), "x", "y", "w")
    sw = F.sum("w")
    return a.groupBy("i").agg(
        F.expr("sum(CAST(x AS BIGINT) * w) div sum(w)").cast("int").alias("x"),
        F.expr("sum(CAST(y AS BIGINT) * w) div sum(w)").cast("int").alias("y"),
        sw.alias("n"))


def step(points: DataFrame, means: Means) -> Means:
    """One iteration; empty clusters keep their old centre."""
    new = list(means)
    for r in step_frame(points, means).collect():   # at most k rows
        new[r["i"]] = (r["x"], r["y"])
    return new


def shift(old: Means, new: Means) -> float:
    """C4: summed squared shift between two centre lists of equal length."""
    if len(old) != len(new):
        raise ValueError(f"means of size {len(old)} vs {len(new)}")
    return float(sum(float(a - c) * float(a - c) + float(b - d) * float(b - d)
                     for (a, b), (c, d) in zip(old, new)))


@dataclass
class FitResult:
    means: Means
    iterations: int
    converged: bool
    trace: list[tuple[int, int, int, int, int, int, float]]  # iter, i, ox, oy, nx, ny, d


def fit(points: DataFrame, means: Means, eta: float = ETA, max_iter: int = MAX_ITERATIONS, strict: bool = False) -> FitResult:
    """Iterate until the shift is below eta or max_iter steps were made (the reference's rule).

    The result says which of the two it was; when strict, centres that have not converged raise."""
    trace = []
    it = 1
    while True:
        new = step(points, means)
        for i, ((ox, oy), (nx, ny)) in enumerate(zip(means, new)):
            trace.append((it, i, ox, oy, nx, ny, shift([(ox, oy)], [(nx, ny)])))
        d = shift(means, new)
        if d < eta:
            return FitResult(new, it, True, trace)
        if it >= max_iter:
            if strict:
                raise RuntimeError(f"k-means has not converged after {it} iterations (shift {d})")
            return FitResult(new, it, False, trace)
        means, it = new, it + 1


def with_state(df: DataFrame, res: FitResult) -> DataFrame:
    """The frame with how the fit ended: ``iterations`` and ``converged``."""
    return df.withColumn("iterations", F.lit(res.iterations)).withColumn("converged", F.lit(res.converged))


def trace_frame(spark: SparkSession, res: FitResult) -> DataFrame:
    return spark.createDataFrame(
        res.trace, "iter int, i int, old_x int, old_y int, new_x int, new_y int, shift double")


def collect_means(means_df: DataFrame, k: int) -> Means:
    """Bring the k starting centres to the driver (k is a parameter, checked)."""
    rows = means_df.orderBy("i").limit(k + 1).collect()
    if len(rows) != k:
        raise ValueError(f"expected {k} initial means, got {len(rows)}")
    return [(int(r["x"]), int(r["y"])) for r in rows]
