"""Exact weighted medians by digits (D15 for groups of any number of distinct values).

A value's 64 bits are read as four digits of 16 bits, from the highest.  Each round sums the weights of a group's
rows by one digit, a partial aggregate spread over tasks by (group, digit), finds by running sums over at most
65,536 digits the one that holds the wanted rank, and goes on with the rows that have it.  A group with millions
of distinct values thus never stands in one task, as it does in the map of ``percentile``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 16
#: Rounds by value type.
ROUNDS = {"tinyint": 1, "smallint": 1, "int": 2, "bigint": 4}


def _digits(value: Column, shift: int) -> Column:
    """The value without its lowest ``shift`` bits (floored, so order is kept below 0 too)."""
    return F.shiftright(value, shift) if shift else value


def weighted_median(rows: DataFrame, group: str, value: str, weight: str = "w") -> DataFrame:
    """``(group, median double)``: what ``percentile(value, 0.5, weight)`` gives, the mean of the two middle values.

    Rows with a null value or weight, or a weight below 1, count for nothing; a group without others has no row.  A null
    group is a group.  Values are integers."""
    kind = rows.schema[value].dataType.simpleString()
    if kind not in ROUNDS:
        raise TypeError(f"{value}: {kind} is no integer type")
    g = F.struct(F.col(group).alias("g"))                               # joins as a struct, so a null group meets itself
    base = rows.where(F.col(value).isNotNull() & (F.col(weight) > 0)).select(g.alias("_g"), F.col(value).cast("long").alias("_v"), F.col(weight).cast("long").alias("_w"))
    totals = base.groupBy("_g").agg(F.sum("_w").alias("n"))
    middle = totals.select("_g", F.explode(F.array_distinct(F.array(F.expr("(n - 1) div 2"), F.expr("n div 2")))).alias("_target"))
    wanted = middle.withColumns({"_rank": F.col("_target"), "_q": F.lit(None).cast("long")})
    for r in range(ROUNDS[kind] - 1, -1, -1):
        shift, first = DIGIT_BITS * r, r == ROUNDS[kind] - 1
        here = base.withColumns({"_p": _digits(F.col("_v"), shift), "_q": F.lit(0).cast("long") if first else _digits(F.col("_v"), shift + DIGIT_BITS)})
        if first:
            wanted = wanted.withColumn("_q", F.lit(0).cast("long"))
        else:
            here = here.join(wanted.select("_g", "_q").distinct(), ["_g", "_q"], "left_semi")
        sums = here.groupBy("_g", "_q", "_p").agg(F.sum("_w").alias("_n")).join(wanted, ["_g", "_q"])
        digits = Window.partitionBy("_g", "_target").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)      # at most 2 ** DIGIT_BITS rows
        sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(digits), F.lit(0)))
        hit = (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
        wanted = sums.where(hit).select("_g", "_target", (F.col("_rank") - F.col("_before")).alias("_rank"), F.col("_p").alias("_q"))
    return wanted.groupBy("_g").agg(F.avg(F.col("_q").cast("double")).alias("median")).select(F.col("_g.g").alias(group), "median")
