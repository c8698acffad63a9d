"""Keyword ranking over a stream of article files (D5 on a streaming DataFrame).

New parquet files with ``(doc_id, text)`` arriving in a folder update the
per-keyword article counts; the aggregate state is kept by Spark in the
checkpoint location, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.keyword_rank import keyword_pairs

ARTICLE_SCHEMA = "doc_id long, text string"


def article_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(ARTICLE_SCHEMA).parquet(folder)


def keyword_counts(articles: DataFrame, keywords: list[str]) -> DataFrame:
    """Running (kw, n); works on batch and streaming frames alike."""
    return keyword_pairs(articles, keywords).groupBy("kw").count().withColumnRenamed("count", "n")


def start_ranking(spark: SparkSession, folder: str, keywords: list[str], checkpoint: str,
                  sink: str, available_now: bool = True) -> StreamingQuery:
    """Run the ranking into a Parquet folder that holds the whole ranking after every batch (complete mode)."""
    counts = keyword_counts(article_stream(spark, folder), keywords)
    writer = (counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(sink)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
