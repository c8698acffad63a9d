"""A corpus pipeline: documents through five stages of ``quarry.llm``, each written as Parquet and read again.

Language ID drops null texts and those without a letter (its threshold hardly ever rejects another text, gibberish
and languages that no label teaches included); the set join keeps one document of each group of near
copies (five words, similarity 0.8); substring dedup removes passages of 35 words that occur again;
decontamination drops documents that hold a benchmark item; packing lays out what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import small_batches, written
from quarry.llm.decontaminate import drop_leaks
from quarry.llm.language_id import keep_identified, train, training_rows
from quarry.llm.packing import pack_documents
from quarry.llm.set_join import keep_one_of_each
from quarry.llm.substring_dedup import without_repeats
from quarry.sources.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined (no text, or none with a letter, goes)."""
    small_batches(spark)
    return keep_identified(docs, train(training_rows(docs)))


def set_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar shingle sets: the one of least id."""
    small_batches(spark)
    return keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that repeated passages cover; n_chars follows the text."""
    small_batches(spark)
    return without_repeats(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    small_batches(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences."""
    small_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("set_join", set_join),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Language scores and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
