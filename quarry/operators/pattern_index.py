"""Substring search for a table of keywords of any length (B19 and G5 with a topic table).

An index of patterns takes the place of one test per keyword.  Every keyword is listed under one of its own
q-grams, the one that fewest texts hold (a keyword shorter than q under itself).  A text that contains the
keyword contains that gram, so texts meet keywords by an equi-join of the texts' distinct grams with the index, and only
those pairs are tested with ``contains``.  Matching is case-sensitive, on code points.

The gram counts read the keywords' grams only (a semi-join before the partial count).  While the keywords are few
(``BROADCAST_CHARS`` in all, checked by a sum) the index is broadcast and texts are tested where they are; beyond
that grams and index are shuffled without the texts, and the candidates meet their texts by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.record_sets import descending

#: Gram length, and characters of all keywords up to which the index is broadcast (a gram a character at most).
Q = 5
BROADCAST_CHARS = 1_000_000


def grams(text: Column | str, q: int) -> Column:
    """The distinct runs of q characters of a text, in one pass over it.

    A look-ahead takes the run at every place.  Beyond U+FFFF a run may also start inside a character; keywords and
    texts give the same runs there, so nothing is missed, and ``contains`` decides."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{q}}}))"), F.lit(1)))


def _listed(keywords: DataFrame, q: int) -> DataFrame:
    """``(kw, gram)``: all grams of each distinct keyword, of q characters or of its own length if it is shorter.
    Null and empty keywords match nothing and are left out."""
    distinct = keywords.select("kw").where(F.col("kw").isNotNull() & (F.col("kw") != "")).distinct()
    by_length = F.lit(None).cast("array<string>")
    for n in range(q, 0, -1):
        by_length = F.when(F.least(F.char_length("kw"), F.lit(q)) == n, grams("kw", n)).otherwise(by_length)
    return distinct.select("kw", F.explode(by_length).alias("gram"))


def _text_grams(texts: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """A row for each text and distinct gram of the lengths that the keywords have."""
    return texts.select(*keep, F.explode(F.concat(*[grams("text", n) for n in lengths])).alias("gram"))


def pattern_index(texts: DataFrame, keywords: DataFrame, q: int = Q, small: bool = False) -> tuple[DataFrame, list[int]]:
    """``(gram, kw)``: each keyword under its rarest gram (ties: the least), and the gram lengths in use (at most q).
    A keyword with a gram that no text has is left out."""
    listed = _listed(keywords, q)
    lengths = sorted(r[0] for r in listed.select(F.least(F.char_length("kw"), F.lit(q))).distinct().collect())       # at most q numbers
    if not lengths:
        return listed.select("gram", "kw"), [q]
    wanted = listed.select("gram").distinct()
    counts = _text_grams(texts, lengths).join(F.broadcast(wanted) if small else wanted, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    missing = listed.join(counts, "gram", "left_anti").select("kw")
    rarest = listed.join(counts, "gram").join(missing, "kw", "left_anti").groupBy("kw").agg(F.min(F.struct("n", "gram")).alias("r"))
    return rarest.select(F.col("r.gram").alias("gram"), "kw"), lengths


def keyword_matches(texts: DataFrame, keywords: DataFrame, q: int = Q, id_col: str = "id", broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """B19 for a keyword table: ``(id, kw)`` for each text (``id_col``, ``text``) and distinct keyword (``kw``) it contains.

    Repeated keywords count once; rows of texts that repeat (also by id) give rows of their own.  Null and empty texts and
    keywords match nothing.  Other columns are not read."""
    base = texts.select(F.col(id_col), "text").where(F.col("text").isNotNull())
    small = (keywords.agg(F.sum(F.char_length("kw"))).collect()[0][0] or 0) <= broadcast_chars
    index, lengths = pattern_index(base, keywords, q, small)
    hit = F.contains(F.col("text"), F.col("kw"))
    if small:
        return _text_grams(base, lengths, id_col, "text").join(F.broadcast(index), "gram").where(hit).select(id_col, "kw")
    # each text row gets a key of its own content, so candidates find it again whatever its id
    keyed = base.withColumn("_key", F.xxhash64(F.col(id_col).cast("string"), "text"))
    pairs = _text_grams(keyed, lengths, "_key").join(index, "gram").select("_key", "kw").distinct()
    return keyed.join(pairs, "_key").where(hit).select(id_col, "kw")


def topic_matches(records: DataFrame, topics: DataFrame, seq: str = "seq", **options) -> DataFrame:
    """``(seq, topic, n_keywords)``: how many of a topic's keywords a record contains, for each topic with one.
    ``topics`` has ``topic`` and ``kw``; a keyword may stand under several topics."""
    pairs = keyword_matches(records, topics, id_col=seq, **options)
    return pairs.join(topics.select("topic", "kw").distinct(), "kw").groupBy(seq, "topic").agg(F.count("*").alias("n_keywords"))


def trending_topics(records: DataFrame, topics: DataFrame, seq: str = "seq", **options) -> DataFrame:
    """G5 with a topic table: the records of a set that contain any topic's keyword, by retweets descending."""
    found = keyword_matches(records, topics, id_col=seq, **options).select(seq).distinct()
    return descending(records.join(found, seq, "left_semi"))
