"""Question/answer scoring over postings.

Postings follow ``sources.text.POSTING_SCHEMA``.  Answers are pre-aggregated
per parent id *before* the join (map-side partial max/count), so a question
holding a third of all answers costs one row per map task in the shuffle,
not a third of the data in one reducer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from quarry.constants import LANG_SPREAD, LANGUAGES


def questions(postings: DataFrame) -> DataFrame:
    """Type-1 postings keyed by id."""
    return postings.filter(F.col("type") == 1).select(F.col("id").alias("qid"), "tags")


def distinct_questions(postings: DataFrame, langs: list[str] = LANGUAGES) -> DataFrame:
    """Questions with one row per id.  An id that stands on several rows takes its least tag in text order among
    the languages; an unknown or null tag only if it has no other (then the least, null last)."""
    unknown = F.coalesce(F.array_position(_langs(langs), F.col("tags")), F.lit(0)) == 0
    best = F.min(F.struct(unknown.alias("unknown"), F.col("tags").isNull().alias("none"), F.col("tags").alias("tags")))
    return questions(postings).groupBy("qid").agg(best.alias("_b")).select("qid", F.col("_b.tags").alias("tags"))


def _langs(langs: list[str]):
    return F.array(*[F.lit(x) for x in langs])


def answers(postings: DataFrame, strict: bool = True, *more: str) -> DataFrame:
    """Type-2 postings keyed by parent id, with their score and other columns named; a missing parent raises when strict."""
    a = postings.filter(F.col("type") == 2)
    if strict:
        pid = F.when(F.col("parent_id").isNull(),
                     F.raise_error(F.concat(F.lit("answer without parent: "), F.col("id").cast("string")))
                     ).otherwise(F.col("parent_id"))
    else:
        a = a.filter(F.col("parent_id").isNotNull())
        pid = F.col("parent_id")
    return a.select(pid.alias("qid"), "score", *more)


def qa_pairs(postings: DataFrame, strict: bool = True) -> DataFrame:
    """Inner equi-join question ⋈ answer; unanswered questions and orphans drop."""
    return questions(postings).join(answers(postings, strict), "qid").select("qid", "tags", "score")


def _answer_stats(postings: DataFrame, strict: bool) -> DataFrame:
    return answers(postings, strict).groupBy("qid").agg(
        F.count("*").alias("n_answers"), F.max("score").alias("max_score"),
        F.min("score").alias("min_score"))


def qa_grouped(postings: DataFrame, strict: bool = True) -> DataFrame:
    """Answered questions grouped by id, as per-group statistics (no lists)."""
    stats = _answer_stats(postings, strict)
    return questions(postings).join(stats, "qid").select(
        "qid", "tags", "n_answers", "max_score", "min_score")


#: Answers in a numbered block, and rows of a hot question that are numbered in one task, about.
BLOCK, BUCKET_ROWS = 1000, 1000


def numbered_answers(postings: DataFrame, strict: bool = True, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(qid, id, score, idx)``: each question's answers numbered from 0 in the order of the md5 of their id (then id, score).

    In two stages, so a question of any size spans tasks: a question with more than ``bucket_rows`` answers is cut into
    ranges of the digest, answers are numbered in their range, and the ranges' counts are summed up before
    them.  Answers that repeat an id stand in one range."""
    a = answers(postings, strict, "id")
    h = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("long")       # 32 bits, in the digest's order
    a = a.withColumn("_h", F.coalesce(h, F.lit(0)))
    large = a.groupBy("qid").agg(F.count("*").alias("_n")).where(F.col("_n") > bucket_rows)
    ranges = F.coalesce(F.expr(f"least((_n + {bucket_rows - 1}) div {bucket_rows}, 1 << 30)"), F.lit(1))
    a = a.join(large, "qid", "left").withColumn("_range", F.shiftright(F.col("_h") * ranges, 32)).drop("_n")
    order = [F.md5(F.col("id").cast("string")).asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("score").asc_nulls_first()]
    inside = a.withColumn("_at", F.row_number().over(Window.partitionBy("qid", "_range").orderBy(*order)) - 1)
    earlier = Window.partitionBy("qid").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)       # a row per range
    starts = a.groupBy("qid", "_range").agg(F.count("*").alias("_n")).select("qid", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return inside.join(starts, ["qid", "_range"]).select("qid", "id", "score", (F.col("_start") + F.col("_at")).alias("idx"))


def qa_groups(postings: DataFrame, strict: bool = True, block: int = BLOCK, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """C2 with the pairs themselves: ``(qid, tags, block, answers)``, each answered question's answers ``(idx, id, score)``
    in numbered blocks of at most ``block``, so no row and no task holds more of a question.  An id on several question rows
    gives a group for each, as the join multiplies them."""
    n = numbered_answers(postings, strict, bucket_rows)
    blocks = (n.groupBy("qid", F.expr(f"idx div {int(block)}").alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("idx", "id", "score"))).alias("answers")))
    return questions(postings).join(blocks, "qid").select("qid", "tags", "block", "answers")


def flattened(groups: DataFrame) -> DataFrame:
    """C1 back from ``qa_groups``: ``(qid, tags, score)``, a row per pair."""
    return groups.select("qid", "tags", F.explode("answers").alias("a")).select("qid", "tags", F.col("a.score").alias("score"))


def scored(postings: DataFrame, strict: bool = True, langs: list[str] = LANGUAGES) -> DataFrame:
    """Highest answer score per answered question, never below 0; one row per question id (the rule for
    repeated ids is ``distinct_questions``').  Both sides are aggregates by id, so the join moves nothing more."""
    stats = _answer_stats(postings, strict)
    return distinct_questions(postings, langs).join(stats, "qid").select(
        "qid", "tags", F.greatest(F.col("max_score"), F.lit(0)).alias("high_score"))


def vectors(scored_df: DataFrame, langs: list[str] = LANGUAGES, spread: int = LANG_SPREAD,
            strict: bool = True) -> DataFrame:
    """(qid, x = first matching language index × spread, y = high score).

    The tag must equal a language exactly; no match, also a null tag, raises when strict and drops the row
    otherwise.
    """
    pos = F.coalesce(F.array_position(_langs(langs), F.col("tags")), F.lit(0))  # 1-based, 0 = none
    if strict:
        idx = F.when(pos > 0, pos - 1).otherwise(
            F.raise_error(F.concat(F.lit("unknown tag: "), F.coalesce(F.col("tags"), F.lit("null")))))
        base = scored_df
    else:
        idx = pos - 1
        base = scored_df.filter(pos > 0)
    return base.select("qid", (idx * F.lit(spread)).cast("int").alias("x"),
                       F.col("high_score").cast("int").alias("y"))


def vectors_from_postings(postings: DataFrame, langs: list[str] = LANGUAGES, spread: int = LANG_SPREAD,
                          strict: bool = True) -> DataFrame:
    """B4–B7 + C1 + D7 fused: (qid, x, y) for every answered question in one aggregate.

    Questions and answers are co-grouped by question id (own id / parent id)
    instead of joined: the tag becomes a rank first (of its language in text order, unknown and null tags
    last), so every aggregation buffer is fixed-width (hash aggregate, map-side combine), the postings are
    scanned and shuffled once, and an id on several question rows takes the same tag as in ``scored``.  Only
    ids holding both a question and an answer survive — the inner-join rule.  An unknown or null tag raises
    (strict) or drops the question, as in ``vectors``.
    """
    is_q, is_a = F.col("type") == 1, F.col("type") == 2
    ordered = sorted(set(langs))                                                 # the language index of each rank
    rank = F.coalesce(F.array_position(_langs(ordered), F.col("tags")), F.lit(0))
    rank = F.when(rank > 0, rank).otherwise(F.lit(len(ordered) + 1)).cast("int")
    if strict:
        parent = F.when(F.col("parent_id").isNull(),
                        F.raise_error(F.concat(F.lit("answer without parent: "), F.col("id").cast("string")))
                        ).otherwise(F.col("parent_id"))
    else:
        parent = F.col("parent_id")
    keyed = postings.filter(is_q | is_a).select(
        F.when(is_q, F.col("id")).otherwise(parent).alias("qid"),
        F.when(is_q, rank).alias("rank"),
        F.when(is_a, F.col("score")).alias("score"))
    g = keyed.groupBy("qid").agg(F.min("rank").alias("rank"), F.max("score").alias("max_score"),
                                 F.count("rank").alias("n_questions"), F.count("score").alias("n_answers"))
    answered = g.filter((F.col("n_questions") > 0) & (F.col("n_answers") > 0) & F.col("qid").isNotNull())
    known = F.col("rank") <= len(ordered)
    idx = F.get(F.array(*[F.lit(langs.index(x)) for x in ordered]), F.col("rank") - 1)
    if strict:
        idx = F.when(known, idx).otherwise(
            F.raise_error(F.concat(F.lit("unknown tag for question "), F.col("qid").cast("string"))))
    else:
        answered = answered.filter(known)
    return answered.select("qid", (idx * F.lit(spread)).cast("int").alias("x"),
                           F.greatest(F.col("max_score"), F.lit(0)).cast("int").alias("y"))


@dataclass
class Counted:
    """A lenient result and, once an action has run on ``rows``, how many rows each reason dropped on the way."""

    rows: DataFrame
    seen: list[Observation]

    def dropped(self) -> dict[str, int]:
        """Counts by reason (waits for the action; it starts none)."""
        return {reason: n or 0 for o in self.seen for reason, n in o.get.items()}


#: Reasons of L3, in the order in which rows meet them.
NO_PARENT, NO_LANGUAGE = "answer without parent", "question with unknown tag"


def counted_vectors(postings: DataFrame, langs: list[str] = LANGUAGES, spread: int = LANG_SPREAD) -> Counted:
    """B5 and B6, not strict, with what they drop counted (L3): answers without a parent, and scored questions whose tag is
    no language.  Spark observes the rows as they pass, so the postings are read as often as without counting.

    A count belongs to the one action that first runs ``rows``; a stage that a lost executor makes Spark run again
    may count its rows again, so the counts say at least what was dropped, and the rows are right in any case."""
    lost, unknown = Observation("lost answers"), Observation("unknown tags")
    is_a = F.col("type") == 2
    passing = postings.observe(lost, F.count_if(is_a & F.col("parent_id").isNull()).alias(NO_PARENT))
    unlisted = F.coalesce(F.array_position(_langs(langs), F.col("tags")), F.lit(0)) == 0
    is_q = F.col("type") == 1
    keyed = passing.filter(is_q | (is_a & F.col("parent_id").isNotNull())).select(
        F.when(is_q, F.col("id")).otherwise(F.col("parent_id")).alias("qid"), "type", "tags", "score")
    least_tag = F.struct(unlisted.alias("unknown"), F.col("tags").isNull().alias("none"), F.col("tags").alias("tags"))
    g = keyed.groupBy("qid").agg(F.min(F.when(is_q, least_tag)).alias("_b"), F.max(F.when(is_a, F.col("score"))).alias("_high"), F.count_if(is_a).alias("_a"))
    high = g.filter(F.col("_b").isNotNull() & (F.col("_a") > 0) & F.col("qid").isNotNull()).select(
        "qid", F.col("_b.tags").alias("tags"), F.greatest(F.col("_high"), F.lit(0)).alias("high_score"))
    high = high.observe(unknown, F.count_if(unlisted).alias(NO_LANGUAGE))
    return Counted(vectors(high, langs, spread, strict=False), [lost, unknown])
