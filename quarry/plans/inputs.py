"""Stand-in inputs derived from the driver tables.

The reference's own data files are not shipped, so each job reads a table
that has the same shape.  These derivations are shared by the Spark
queries and (as SQL text) by the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tables import table

# Stand-in parameters: keyword list for ranking over `documents`.
KEYWORDS = ["the", "le", "and", "of,", "zzz-absent"]

# Stand-in parameters: question tags in language-list order, and k-means settings.
LANGS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
LANG_SPREAD = 50000
KERNELS = 15
ETA = 20.0
MAX_ITERATIONS = 120
SAMPLE_SEED = 42
SAMPLE_METHOD = "per_group"

# Stand-in parameters: record sources in list order (``source`` of documents).
SOURCES = [f"src{i}" for i in range(20)]

# Stand-in parameters: topic keyword lists for the record-set queries.
TOPIC_A = ["the", "The"]
TOPIC_B = ["le", "Le"]


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles = documents (id, text)."""
    return table(spark, sf, "documents").select("doc_id", "text")


def postings(spark: SparkSession, sf: str) -> DataFrame:
    """Postings from orders (questions, type 1) and lineitem (answers, type 2).

    question: id = o_orderkey, tags = o_orderpriority, score = 0,
              accepted = o_orderkey*10+1 when the order status is 'F'.
    answer:   id = l_orderkey*10 + l_linenumber, parent = l_orderkey,
              score = int(l_quantity) - 25, no tags.
    """
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    q = o.select(F.lit(1).alias("type"), F.col("o_orderkey").alias("id"),
                 F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") * 10 + 1).alias("accepted"),
                 F.lit(None).cast("long").alias("parent_id"), F.lit(0).alias("score"),
                 F.col("o_orderpriority").alias("tags"))
    a = li.select(F.lit(2).alias("type"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                  F.lit(None).cast("long").alias("accepted"), F.col("l_orderkey").alias("parent_id"),
                  (F.col("l_quantity").cast("int") - 25).alias("score"),
                  F.lit(None).cast("string").alias("tags"))
    return q.unionByName(a)


def posting_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The same postings rendered as headerless CSV lines (column ``value``)."""
    p = postings(spark, sf)
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return p.select(F.concat_ws(",", s("type"), s("id"), s("accepted"), s("parent_id"),
                                s("score"), s("tags")).alias("value"))


def article_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents rendered in the article line layout (14-char head, 16-char tail)."""
    d = table(spark, sf, "documents")
    return d.select(F.concat(F.lit("<page> <title>"), F.col("doc_id").cast("string"),
                             F.lit("</title><text>"), F.col("text"),
                             F.lit("</text> </page> ")).alias("value"))


# Survey stand-in on lineitem: id text, then doubles; activity groups by prefix.
WIDE_PRIMARY = ["l_ext"]
WIDE_WORK = ["l_q", "l_tax"]
WIDE_OTHER = ["l_"]


def wide(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    d = lambda c: F.col(c).cast("double")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("tucaseid"),
        d("l_linenumber").alias("telfs"),
        (F.col("l_suppkey") % 2 + 1).cast("double").alias("tesex"),
        d("l_quantity").alias("teage"),
        d("l_orderkey").alias("l_orderkey"), d("l_partkey").alias("l_partkey"),
        d("l_suppkey").alias("l_suppkey"), d("l_linenumber").alias("l_linenumber"),
        d("l_quantity").alias("l_quantity"), d("l_extendedprice").alias("l_extendedprice"),
        d("l_discount").alias("l_discount"), d("l_tax").alias("l_tax"))


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Record list = documents: user = source, retweets = n_chars, seq = doc_id."""
    d = table(spark, sf, "documents")
    return d.select(F.col("source").alias("user"), "text", F.col("n_chars").cast("int").alias("retweets"),
                    F.col("doc_id").alias("seq"), "lang", "source")


def words(spark: SparkSession, sf: str) -> DataFrame:
    """Word occurrences of documents: runs of letters of any alphabet, lower-cased, one row each."""
    return letter_words(table(spark, sf, "documents"))


def letter_words(df: DataFrame, text: str = "text") -> DataFrame:
    w = df.select(F.explode(F.split(text, "[^\\p{L}]+")).alias("word"))
    return w.filter(F.col("word") != "").select(F.lower("word").alias("word"))


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct sentences of documents, the stretches between full stops and line ends, without blank ones."""
    d = table(spark, sf, "documents").select(F.explode(F.split("text", "[.\\n]")).alias("sentence"))
    return d.select(F.trim("sentence").alias("sentence")).filter(F.col("sentence") != "").distinct()


def part_names(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct part names, the 'sentences' of the anagram jobs."""
    return table(spark, sf, "part").select(F.col("p_name").alias("sentence")).distinct()


def topics(spark: SparkSession, sf: str, shortest: int) -> DataFrame:
    """Topic table = words of at least so many letters of ``benchmark`` items (topic = item_id, kw)."""
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("topic"), F.explode(F.split("text", "[^\\p{L}]+")).alias("kw"))
    return b.filter(F.char_length("kw") >= shortest).distinct()


def price_points(spark: SparkSession, sf: str) -> DataFrame:
    """Integer points = order lines (x = price in whole units, y = part)."""
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.floor("l_extendedprice").cast("int").alias("x"),
                                               F.col("l_partkey").cast("int").alias("y"))


def customer_centres(spark: SparkSession, sf: str) -> DataFrame:
    """A table of many centres = customers (i = key, x = balance in tenths, y = key)."""
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("i"), F.floor(F.col("c_acctbal") * 10).cast("int").alias("x"),
                                               F.col("c_custkey").cast("int").alias("y"))


def hot_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Postings with few questions and many answers to each: regions (questions) and orders (answers, by customer)."""
    r = table(spark, sf, "region").select(F.lit(1).alias("type"), F.col("r_regionkey").cast("long").alias("id"), F.lit(None).cast("long").alias("parent_id"),
                                          F.lit(0).alias("score"), F.col("r_name").alias("tags"))
    o = table(spark, sf, "orders").select(F.lit(2).alias("type"), F.col("o_orderkey").cast("long").alias("id"), (F.col("o_custkey") % 5).cast("long").alias("parent_id"),
                                          F.floor("o_totalprice").cast("int").alias("score"), F.lit(None).cast("string").alias("tags"))
    return r.unionByName(o)


def lossy_postings(spark: SparkSession, sf: str) -> DataFrame:
    """The postings with lost values: answers whose score 7 divides have no parent, and urgent questions have no tag."""
    p = postings(spark, sf)
    lost = (F.col("type") == 2) & (F.col("score") % 7 == 0)
    return p.withColumns({"parent_id": F.when(~lost, F.col("parent_id")), "tags": F.when(F.col("tags") != LANGS[0], F.col("tags"))})
