"""The descending list of a record set by position (F5 for any place, not only its head).

``RankedList`` deals the records out by ranges of the list's order, sorted in each; every range counts its records once,
and a record's rank is the number before its range plus its place in it.  No task holds more than a range, there is
no window over the whole list, and a page reads the ranges alone that hold it.  The driver holds a number a range.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.record_sets import REC
from quarry.session import cut_lineage, release

#: Characters of a text that decide, with the count, to which range a record goes (the driver sees no whole texts).
LEAD = 32


class RankedList:
    """The records of a set by retweets, descending, then by text, as ``record_sets.descending`` has them.

    Records beyond ``REC`` keep their other columns.  Repeated records have ranks of their own.  ``release`` frees what
    is held when the list is no longer read."""

    def __init__(self, s: DataFrame):
        self.columns = s.columns
        order = [F.desc("retweets"), F.asc("text")]
        dealt = s.repartitionByRange(F.desc("retweets"), F.asc(F.substring("text", 1, LEAD))).sortWithinPartitions(*order)
        self.held = cut_lineage(dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
        counts = {r["_part"]: (r["n"], r["lo"]) for r in self.held.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("lo")).collect()}
        self.parts = sorted(counts)
        self.starts = [0, *accumulate(counts[p][0] for p in self.parts)]
        self.low = [counts[p][1] for p in self.parts]

    def __len__(self) -> int:
        return self.starts[-1]

    def _rank(self) -> Column:
        shifts = self.held.sparkSession.createDataFrame([(p, s - low) for p, s, low in zip(self.parts, self.starts, self.low)], "_part int, _shift long")
        return self.held.join(F.broadcast(shifts), "_part").withColumn("rank", F.col("_at") + F.col("_shift"))         # a row a range

    def ranks(self) -> DataFrame:
        """All records with ``rank``, from 0."""
        return self._rank().select(*self.columns, "rank")

    def page(self, start: int, count: int) -> DataFrame:
        """The records of rank ``start`` to ``start + count``, with ``rank``, in order; fewer, or none, at the list's end."""
        if start < 0 or count < 0:
            raise ValueError("a page has no negative start or count")
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, start + count - 1)
        own = self.parts[max(0, first):last] if count else []
        rows = self._rank().where(F.col("_part").isin(own) & (F.col("rank") >= start) & (F.col("rank") < start + count))
        return rows.select(*self.columns, "rank").orderBy("rank")

    def nth(self, n: int) -> DataFrame:
        """The record of rank n; beyond the list it raises, as ``head`` of an empty list does."""
        if not 0 <= n < len(self):
            raise IndexError(f"no record {n} in a list of {len(self)}")
        return self.page(n, 1).select(*self.columns)

    def drop(self, n: int) -> DataFrame:
        """The list without its first n records, the n-th tail; more than the list has raises."""
        if not 0 <= n <= len(self):
            raise IndexError(f"no tail {n} in a list of {len(self)}")
        return self.page(n, max(0, len(self) - n)).select(*self.columns)

    def release(self) -> None:
        release(self.held)


def list_page(s: DataFrame, start: int, count: int) -> DataFrame:
    """One page ``(user, text, retweets, rank)`` of a set's list; what was held for it is released (a page is small)."""
    ranked = RankedList(s.select(*REC))
    try:
        page = ranked.page(start, count)
        return s.sparkSession.createDataFrame(page.collect(), page.schema)
    finally:
        ranked.release()
