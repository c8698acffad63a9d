"""Key-set algebra on one-column tables ``k``.

The reference's sets are predicates that can only be enumerated inside
[-1000, 1000].  Here a set is a table of distinct keys; the bound is a
parameter (``None``, the default, = the whole table) and applies where the
reference enumerates: forall, exists, map and the text form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A predicate or function of a key: Python on a column, or an SQL expression in ``k``.
KeyExpr = Callable[[Column], Column] | str


def _of_key(f: KeyExpr) -> Column:
    return F.expr(f) if isinstance(f, str) else f(F.col("k"))


def key_rows(df: DataFrame, col: str) -> DataFrame:
    """The keys of a column, repeats included (for ``union``, which de-duplicates once)."""
    return df.select(F.col(col).alias("k")).filter(F.col("k").isNotNull())


def keys(df: DataFrame, col: str) -> DataFrame:
    """A key set from a column (distinct, nulls dropped)."""
    return df.select(F.col(col).alias("k")).filter(F.col("k").isNotNull()).distinct()


def singleton(spark: SparkSession, elem: int) -> DataFrame:
    """G6."""
    return spark.createDataFrame([(elem,)], "k long")


def union(s: DataFrame, t: DataFrame) -> DataFrame:
    """G7 (both sides are sets of distinct keys, so one de-duplication of the whole does)."""
    return s.union(t).distinct()


def intersect(s: DataFrame, t: DataFrame) -> DataFrame:
    """G8."""
    return s.intersect(t)


def diff(s: DataFrame, t: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT."""
    return s.subtract(t)


def filter_keys(s: DataFrame, p: KeyExpr) -> DataFrame:
    """B21."""
    return s.filter(_of_key(p))


def _bounded(s: DataFrame, bound: int | None) -> DataFrame:
    return s if bound is None else s.filter(F.col("k").between(-bound, bound))


def contains(s: DataFrame, probe: DataFrame) -> DataFrame:
    """B20 in bulk: every probe key with ``contained`` (``s`` holds distinct keys)."""
    hits = s.select("k").withColumn("_hit", F.lit(True))
    return probe.select("k").join(hits, "k", "left").select(
        "k", F.coalesce("_hit", F.lit(False)).alias("contained"))


def map_keys(s: DataFrame, f: KeyExpr, bound: int | None = None) -> DataFrame:
    """Image of the (bounded) set under f; the image itself is not bounded."""
    return _bounded(s, bound).select(_of_key(f).alias("k")).distinct()


def forall(s: DataFrame, p: KeyExpr, bound: int | None = None) -> DataFrame:
    """Every element satisfies p (true on an empty set)."""
    return _bounded(s, bound).agg(F.coalesce(F.bool_and(_of_key(p)), F.lit(True)).alias("forall"))


def exists(s: DataFrame, p: KeyExpr, bound: int | None = None) -> DataFrame:
    """Some element satisfies p (false on an empty set)."""
    return _bounded(s, bound).agg(F.coalesce(F.bool_or(_of_key(p)), F.lit(False)).alias("exists"))


def render(s: DataFrame, bound: int | None = None, width: int = 1000) -> DataFrame:
    """The whole set as text, one row per key range: ``(lo, text)`` with ``{a,b,c}`` ascending for the keys
    from ``lo`` to ``lo + width - 1``, so no row holds more than ``width`` keys.  ``bound`` limits the keys to
    [-bound, bound] (the reference's rule is KEYSET_BOUND)."""
    b = _bounded(s, bound).select("k", (F.floor(F.col("k") / width) * width).alias("lo"))
    return b.groupBy("lo").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_set("k")), ","), F.lit("}")).alias("text"))
