"""Sum and maximum of a column with the reference's empty-input rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total(df: DataFrame, col: str) -> DataFrame:
    """Sum, 0 when empty."""
    return df.agg(F.coalesce(F.sum(col), F.lit(0)).alias("total"))


def maximum(df: DataFrame, col: str) -> DataFrame:
    """Maximum; raises on empty input."""
    m = F.max(col)
    return df.agg(F.when(m.isNull(), F.raise_error(F.lit("max of an empty list"))).otherwise(m).alias("maximum"))
