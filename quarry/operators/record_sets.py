"""Record sets keyed by text, with defined clash rules.

A set holds at most one record per ``text``.  Building a set keeps the
*first* record (lowest ``seq``, a unique record number); a union keeps the
*argument's* record on a clash; a union of many sources keeps the *last*
source's record.  Sets are worked on as *members*, small rows ``(digest,
seq)`` with the text's SHA-256: each rule is an aggregate or an equi-join on
the digest, and ``fetch`` joins the winners' records back by ``seq`` — the
one time a text is moved.  No join, aggregate or sort is keyed on a text
(the ordered list and its head break ties by it).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.constants import APPLE_KEYWORDS, GOOGLE_KEYWORDS, SITES
from quarry.functions.text import contains_any

REC = ["user", "text", "retweets"]
#: Characters of a text that decide, with the count, to which range of the descending list a record goes.
LEAD = 32


def digest(text: Column | str = "text") -> Column:
    """SHA-256 of a text (a null text has a digest of its own)."""
    return F.coalesce(F.sha2(F.col(text) if isinstance(text, str) else text, 256), F.lit("null"))


def members(records: DataFrame, seq: str = "seq") -> DataFrame:
    """G1/G2 as ``(digest, seq)``: the first record of each text."""
    return records.select(digest().alias("digest"), seq).groupBy("digest").agg(F.min(seq).alias(seq))


def fetch(chosen: DataFrame, records: DataFrame, seq: str = "seq") -> DataFrame:
    """The records of the chosen members (``seq`` is unique per record)."""
    return records.select(*REC, seq).join(chosen.select(seq), seq).select(*REC, seq)


def to_set(records: DataFrame, seq: str = "seq") -> DataFrame:
    """One record per text, the first by ``seq`` wins."""
    return fetch(members(records, seq), records, seq)


def _digests(s: DataFrame) -> DataFrame:
    return s.select("digest") if "digest" in s.columns else s.select(digest().alias("digest"))


def union_members(this: DataFrame, that: DataFrame) -> DataFrame:
    """G3 on members: all of ``that`` and those of ``this`` whose text ``that`` lacks."""
    return that.unionByName(this.join(that.select("digest"), "digest", "left_anti").select(*that.columns))


def union(this: DataFrame, that: DataFrame, seq: str = "seq") -> DataFrame:
    """Union of two sets of records by text; on a clash the argument (``that``) wins."""
    cols = [*REC, seq]
    missing = this.select(*cols, digest().alias("digest")).join(_digests(that), "digest", "left_anti")
    return that.select(*cols).unionByName(missing.select(*cols))


def union_all(records: DataFrame, source_rank: Column, seq: str = "seq") -> DataFrame:
    """Union of all sources left to right: the last source wins, first record within it."""
    r = records.select(digest().alias("digest"), seq, source_rank.alias("_rank"))
    firsts = r.groupBy("digest", "_rank").agg(F.min(seq).alias(seq))            # set per source
    winners = firsts.groupBy("digest").agg(F.max_by(seq, "_rank").alias(seq))   # last source wins
    return fetch(winners, records, seq)


def source_rank(site: Column | str, sites: list[str] = SITES) -> Column:
    """A10: a source's place in the ordered site list, from 0; a site that is not listed raises."""
    c = F.col(site) if isinstance(site, str) else site
    at = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in sites]), c), F.lit(0))
    return F.when(at > 0, at - 1).otherwise(F.raise_error(F.concat(F.lit("unknown source: "), F.coalesce(c, F.lit("null"))))).cast("int")


def named_sources(names: list[str], frames: list[DataFrame], column: str = "source") -> DataFrame:
    """Names zipped with their record frames, in that order, as one frame with the name in ``column``."""
    if len(names) != len(frames) or not names:
        raise ValueError(f"{len(names)} names for {len(frames)} sources")
    return reduce(DataFrame.unionByName, [f.withColumn(column, F.lit(n)) for n, f in zip(names, frames, strict=True)])


def by_site(records: DataFrame, site: str, sites: list[str] = SITES, column: str = "source") -> DataFrame:
    """A10: the records of one listed source."""
    if site not in sites:
        raise KeyError(site)
    return records.filter(F.col(column) == site)


def size(s: DataFrame) -> DataFrame:
    """D26 (of members or of records: both have one row per text)."""
    return s.agg(F.count("*").alias("n"))


def filter_set(s: DataFrame, predicate: Column) -> DataFrame:
    """B17."""
    return s.filter(predicate)


def contains(s: DataFrame, probe: DataFrame) -> DataFrame:
    """B18 in bulk: every probe row with ``contained`` = its text is in the set.

    Either side may come with ``digest`` in place of its text, which keeps texts out of the join."""
    keys = _digests(s).withColumn("_hit", F.lit(True))
    own = "digest" in probe.columns
    out = (probe if own else probe.withColumn("digest", digest())).join(keys, "digest", "left").withColumn(
        "contained", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")
    return out if own else out.drop("digest")


def remove(s: DataFrame, removed: DataFrame) -> DataFrame:
    """Drop records (or members) whose text is among the removed records' texts."""
    own = "digest" in s.columns
    left = s if own else s.withColumn("digest", digest())
    out = left.join(_digests(removed), "digest", "left_anti")
    return out.select(*s.columns)


def most_retweeted(s: DataFrame, strict: bool = True) -> DataFrame:
    """The record with most retweets (ties → lowest text); empty set raises when strict."""
    best = F.min_by(F.struct(*REC), F.struct(-F.col("retweets"), F.col("text")))
    out = s.agg(best.alias("_r"))
    r = F.col("_r")
    if strict:
        r = F.when(r.isNull(), F.raise_error(F.lit("most_retweeted of an empty set"))).otherwise(r)
        return out.select(r.alias("_r")).select("_r.*")
    return out.filter(r.isNotNull()).select("_r.*")


def descending(s: DataFrame) -> DataFrame:
    """all records by retweets, descending (text breaks ties).

    Ranges are told apart by the count and the text's first characters, so the driver samples no whole texts; each
    range is sorted by the whole text."""
    dealt = s.repartitionByRange(F.desc("retweets"), F.asc(F.substring("text", 1, LEAD)))
    return dealt.sortWithinPartitions(F.desc("retweets"), F.asc("text"))


def is_empty(s: DataFrame) -> DataFrame:
    """one row, whether the list has no record."""
    return s.agg((F.count("*") == 0).alias("is_empty"))


def head(s: DataFrame) -> DataFrame:
    """the first record of the descending list; an empty list raises."""
    return most_retweeted(s, strict=True)


def head_flagged(s: DataFrame) -> DataFrame:
    """the descending list with its head marked.

    The head is a global ``min_by`` (partial aggregate) used as a scalar
    subquery — no row numbering over the whole set, no join.
    """
    first = s.agg(F.min_by("text", F.struct(-F.col("retweets"), F.col("text")))).scalar()
    return s.select(*REC, F.coalesce(F.col("text") == first, F.lit(False)).alias("is_head"))


def tail(s: DataFrame) -> DataFrame:
    """the descending list without its head.  (An empty list has no tail: see ``head`` and ``is_empty``.)"""
    return descending(head_flagged(s).filter(~F.col("is_head")).select(*REC))


def render(s: DataFrame) -> DataFrame:
    """``User: u\\nText: t [n]``."""
    return s.select(F.concat(F.lit("User: "), "user", F.lit("\nText: "), "text",
                             F.lit(" ["), F.col("retweets").cast("string"), F.lit("]")).alias("line"))


def topic(s: DataFrame, keywords: list[str]) -> DataFrame:
    """Records whose text contains any keyword (substring, case-sensitive)."""
    return s.filter(contains_any("text", keywords))


def trending(s: DataFrame, topic_a: list[str] = GOOGLE_KEYWORDS, topic_b: list[str] = APPLE_KEYWORDS,
             seq: str = "seq") -> DataFrame:
    """Topic A ∪ topic B (B wins clashes), by retweets descending.

    Both topics are subsets of the same set, so a clashing text carries the
    same record on both sides and the union is one filter with both lists.
    """
    return descending(topic(s, list(topic_a) + [k for k in topic_b if k not in topic_a]))
