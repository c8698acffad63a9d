"""Cluster report after k-means.

Works on weighted points (x, y, w): dominant language by summed weight
(ties → lowest language index), its share in percent, cluster size and the
exact median score (weighted ``percentile``, which keeps one counter per
distinct score, so memory is bounded by distinct values, not by rows).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.constants import LANG_SPREAD, LANGUAGES, REPORT_HEADER, REPORT_LINE
from quarry.operators.kmeans import Means, nearest


def report(points: DataFrame, means: Means, langs: list[str] = LANGUAGES, spread: int = LANG_SPREAD,
           median: Callable[[DataFrame, str, str, str], DataFrame] | None = None) -> DataFrame:
    """D16.  ``median`` gives the medians another way, as ``selection.weighted_median``, which spreads a cluster with many
    distinct scores over tasks."""
    a = points.select(nearest("x", "y", means).alias("cluster"), "x", "y", "w")
    per_lang = a.groupBy("cluster", "x").agg(F.sum("w").alias("n"))
    # exact tie-break key: more weight first, then the lower language index
    n_langs = len(langs)
    key = F.col("n") * n_langs + (n_langs - 1 - F.expr(f"x div {int(spread)}"))
    dom = per_lang.groupBy("cluster").agg(
        F.max_by("x", key).alias("dom_x"),
        F.max("n").alias("dom_n"), F.sum("n").alias("size"))
    if median is None:
        med = a.groupBy("cluster").agg(F.percentile(F.col("y"), F.lit(0.5), F.col("w")).alias("_m"))
    else:
        med = median(a, "cluster", "y", "w").withColumnRenamed("median", "_m")
    label = F.element_at(F.array(*[F.lit(x) for x in langs]),
                         F.expr(f"dom_x div {int(spread)}").cast("int") + 1)
    return dom.join(med, "cluster").select(
        "cluster", label.alias("label"),
        ((F.col("dom_n").cast("double") / F.col("size")) * 100).alias("percent"),
        F.col("size").cast("long").alias("size"),
        F.col("_m").cast("int").alias("median"),
    ).orderBy("median", "cluster")


def report_text(rep: DataFrame) -> DataFrame:
    """The printed report as numbered lines — the header, then one line per cluster by median.

    Numbering runs over the k report rows only (a window over k rows).
    """
    spark = rep.sparkSession
    header = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("line_no"), F.lit(t).alias("line")) for i, t in enumerate(REPORT_HEADER)])))
    order = Window.orderBy("median", "cluster")
    body = rep.select((F.row_number().over(order) + len(REPORT_HEADER) - 1).alias("line_no"),
                      F.format_string(REPORT_LINE, "median", "label", "percent", "size").alias("line"))
    return header.unionByName(body).orderBy("line_no")
