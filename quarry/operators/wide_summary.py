"""Wide-survey summary in DataFrame, SQL and fixed-schema forms.

The input is one text id column followed by many numeric columns whose
names say which activity they measure.  Column classification is driver
work on names only; everything else is one projection and one aggregate.
The filter on ``telfs`` is placed before the projection so it is pushed to
the scan.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import OTHER_PREFIXES, PRIMARY_PREFIXES, WORK_PREFIXES

SUMMARY_SCHEMA = T.StructType([
    T.StructField("working", T.StringType(), False),
    T.StructField("sex", T.StringType(), False),
    T.StructField("age", T.StringType(), False),
    T.StructField("primaryNeeds", T.DoubleType(), True),
    T.StructField("work", T.DoubleType(), True),
    T.StructField("other", T.DoubleType(), True),
])
KEYS = ["working", "sex", "age"]
MEASURES = ["primaryNeeds", "work", "other"]


def classify_columns(columns: list[str], primary=PRIMARY_PREFIXES, work=WORK_PREFIXES,
                     other=OTHER_PREFIXES) -> tuple[list[str], list[str], list[str]]:
    """First matching group wins (primary → work → other); unmatched names dropped."""
    groups: tuple[list[str], list[str], list[str]] = ([], [], [])
    for name in columns:
        for g, prefixes in enumerate((primary, work, other)):
            if any(name.startswith(p) for p in prefixes):
                groups[g].append(name)
                break
    return groups


def hours(cols: list[str], group: str) -> Column:
    """Sum of the group's minute columns, in hours; an empty group is an error."""
    if not cols:
        raise ValueError(f"activity group {group!r} has no columns")
    return reduce(add, [F.col(c) for c in cols]) / 60


def summary(df: DataFrame, primary: list[str], work: list[str], other: list[str]) -> DataFrame:
    """Status, sex, age band and the three hour sums; people with telfs > 4 dropped."""
    telfs, tesex, teage = F.col("telfs"), F.col("tesex"), F.col("teage")
    return df.filter(telfs <= 4).select(
        F.when((telfs >= 1) & (telfs < 3), "working").otherwise("not working").alias("working"),
        F.when(tesex == 1, "male").otherwise("female").alias("sex"),
        F.when((teage >= 15) & (teage <= 22), "young")
         .when((teage >= 23) & (teage <= 55), "active").otherwise("elder").alias("age"),
        hours(primary, "primary").alias("primaryNeeds"),
        hours(work, "work").alias("work"),
        hours(other, "other").alias("other"),
    )


def typed(df: DataFrame) -> DataFrame:
    """Rows bound to the fixed record schema by name (reorders, casts, drops extras)."""
    return df.to(SUMMARY_SCHEMA)


def grouped(summed: DataFrame) -> DataFrame:
    """Mean hours per (working, sex, age), one decimal, sorted by the keys."""
    return summed.groupBy(*KEYS).agg(*[F.round(F.avg(m), 1).alias(m) for m in MEASURES]) \
        .orderBy(*KEYS).select(*KEYS, *MEASURES)


def grouped_sql_text(table: str) -> str:
    """The grouping as SQL text, from the key and measure lists."""
    keys = ", ".join(KEYS)
    return f"SELECT {keys}, " + ", ".join(f"round(avg({m}), 1) AS {m}" for m in MEASURES) + f" FROM {table} GROUP BY {keys} ORDER BY {keys}"


def grouped_sql(spark: SparkSession, summed: DataFrame) -> DataFrame:
    """The same through SQL text on the frame (Spark drops the view it makes for it)."""
    return spark.sql(grouped_sql_text("{summed}"), summed=summed)


def grouped_typed(ds: DataFrame) -> DataFrame:
    """The same on fixed-schema rows, mapped back to the record schema."""
    t = typed(ds)
    return t.groupBy(*KEYS).agg(*[F.round(F.avg(m), 1).alias(m) for m in MEASURES]) \
        .to(SUMMARY_SCHEMA).orderBy(*KEYS)


def column_report(df: DataFrame, names: list[str], labels: dict[str, str]) -> DataFrame:
    """One scan: per column its position, label and non-null / null counts."""
    agg = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(names)],
                 F.count(F.lit(1)).alias("_rows"))
    items = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name"), F.lit(labels[c]).alias("label"),
                               F.col(f"n{i}").alias("n_values")) for i, c in enumerate(names)])
    return agg.select(F.inline(items), "_rows").select(
        "pos", "name", "label", "n_values", (F.col("_rows") - F.col("n_values")).alias("nulls"))
