"""The registered queries of this subpackage: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import small_batches
from quarry.llm.decontaminate import find_leaks
from quarry.llm.language_id import identify_languages
from quarry.llm.license_scan import scan_licenses
from quarry.llm.packing import pack_documents
from quarry.llm.merkle import manifest_proofs, without_line_feeds
from quarry.llm.oracle import LLM_ORACLE
from quarry.llm.page_extract import extract_pages
from quarry.llm.preference_format import preference_pairs
from quarry.llm.ranked_search import top_documents
from quarry.llm.set_join import shingle_components
from quarry.llm.substring_dedup import dedup_substrings
from quarry.llm.token_files import token_files
from quarry.llm.toxicity import score_toxicity
from quarry.llm.vector_dedup import near_vectors
from quarry.sources.tables import table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}



def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf)
    LLM_QUERIES[fn.__name__] = run
    return run


@query
def op1_repair_files(spark: SparkSession, sf: str) -> DataFrame:
    return token_files(table(spark, sf, "documents"))


@query
def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_substrings(table(spark, sf, "documents"))


@query
def op3_set_join(spark: SparkSession, sf: str) -> DataFrame:
    return shingle_components(table(spark, sf, "documents"))


@query
def op4_license_templates(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licenses(table(spark, sf, "documents")).drop("spans")


@query
def op5_vector_cells(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors(table(spark, sf, "embeddings"))


@query
def op6_order_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"))


@query
def op7_language_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return identify_languages(table(spark, sf, "documents"))


@query
def op8_simhash_windows(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op9_preference_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return preference_pairs(table(spark, sf, "conversations"))


@query
def op10_page_field(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(table(spark, sf, "pages"))


@query
def op11_swapped_identity(spark: SparkSession, sf: str) -> DataFrame:
    return score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op12_postorder_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest_proofs(table(spark, sf, "documents"), without_line_feeds())


@query
def op13_best_positions(spark: SparkSession, sf: str) -> DataFrame:
    return top_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
