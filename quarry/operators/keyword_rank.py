"""Keyword ranking and inverted index over article texts.

Articles are rows ``(id, text)``; a keyword matches a whole space-separated
token, case-sensitively.  Keyword lists given as Python lists are bounded
parameters and travel in the plan as literals; a keyword *table* goes
through an equi-join that AQE may turn into a broadcast after measuring it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import mentions, space_tokens


def keyword_table(spark: SparkSession, keywords: list[str]) -> DataFrame:
    """Keywords with their list position (ties in rankings keep list order).

    Built as a constant relation, so the planner knows its (tiny) size and
    broadcasts it instead of the article side.
    """
    rows = F.array(*[F.struct(F.lit(k).alias("kw"), F.lit(i).alias("pos")) for i, k in enumerate(keywords)])
    return spark.range(1).select(F.inline(rows))


def flag_mentions(articles: DataFrame, keywords: list[str], id_col: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """B1 for a keyword list: one row per article with a struct ``flags``, field ``m<i>`` for the i-th keyword."""
    toks = articles.select(id_col, space_tokens(text).alias("_t"))
    return toks.select(id_col, F.struct(*[F.array_contains("_t", F.lit(k)).alias(f"m{i}") for i, k in enumerate(keywords)]).alias("flags"))


def articles_mentioning(articles: DataFrame, keyword: str, text: str = "text") -> DataFrame:
    """B2: articles whose text contains the keyword token."""
    return articles.filter(mentions(text, keyword))


def keyword_pairs(articles: DataFrame, keywords: list[str] | DataFrame,
                  id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (kw, id) per keyword found in an article, each at most once.

    List form: ``array_intersect`` with a literal array, a narrow projection
    (no shuffle at all).  Table form (``kw`` column): distinct tokens per
    article, then an equi-join on the token.
    """
    if isinstance(keywords, DataFrame):
        toks = articles.select(id_col, F.explode(F.array_distinct(space_tokens(text))).alias("kw"))
        return toks.join(keywords.select("kw").distinct(), "kw").select("kw", id_col)
    lits = F.array(*[F.lit(k) for k in keywords])
    return articles.select(id_col, F.explode(F.array_intersect(space_tokens(text), lits)).alias("kw")) \
        .select("kw", id_col)


def count_mentions(articles: DataFrame, keyword: str, text: str = "text") -> DataFrame:
    """Number of articles mentioning one keyword (partial + final count)."""
    return articles.agg(F.count_if(mentions(text, keyword)).cast("long").alias("n")) \
        .select(F.lit(keyword).alias("kw"), "n")


def rank_all(articles: DataFrame, keywords: list[str], text: str = "text") -> DataFrame:
    """Every keyword with its article count, zero counts kept; desc count, list order.

    One scan: a single global aggregate with one ``count_if`` per keyword,
    then the bounded (#keywords) row is unpivoted.
    """
    toks = articles.select(space_tokens(text).alias("_t"))
    counts = toks.agg(*[F.count_if(F.array_contains("_t", F.lit(k))).cast("long").alias(f"c{i}")
                        for i, k in enumerate(keywords)])
    pairs = F.array(*[F.struct(F.lit(k).alias("kw"), F.lit(i).alias("pos"), F.col(f"c{i}").alias("n"))
                      for i, k in enumerate(keywords)])
    return counts.select(F.inline(pairs)).orderBy(F.desc("n"), "pos").select("kw", "n")


#: Article ids per block of a posting list.
BLOCK = 4096


def make_index(articles: DataFrame, keywords: list[str] | DataFrame,
               id_col: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """D3: inverted index ``(kw, block, ids)``: the ascending article ids of each keyword, in posting lists by
    blocks of ``block`` consecutive ids, so a row is bounded whatever the keyword.  Article ids are unique.

    Keywords without articles are absent; ids, never article bodies."""
    pairs = keyword_pairs(articles, keywords, id_col, text)
    return pairs.groupBy("kw", F.floor(F.col(id_col) / block).alias("block")).agg(F.array_sort(F.collect_list(id_col)).alias("ids"))


def rank_from_index(index: DataFrame) -> DataFrame:
    """Rank keywords by the sizes of their posting lists; zero-count keywords absent."""
    return index.groupBy("kw").agg(F.sum(F.size("ids")).alias("n")).orderBy(F.desc("n"), "kw")


def rank_reduce(articles: DataFrame, keywords: list[str] | DataFrame,
                id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs counted with a map-side combine; zero-count keywords absent.

    With a keyword table, tokens are counted before they meet it, so a frequent token crosses the shuffle as
    one row per task."""
    if isinstance(keywords, DataFrame):
        counts = articles.select(F.explode(F.array_distinct(space_tokens(text))).alias("kw")).groupBy("kw").agg(F.count("*").alias("n"))
        found = counts.join(keywords.select("kw").distinct(), "kw").select("kw", "n")
    else:
        found = keyword_pairs(articles, keywords, id_col, text).groupBy("kw").agg(F.count("*").alias("n"))
    return found.orderBy(F.desc("n"), "kw")
