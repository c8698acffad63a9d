"""Removal of word passages that occur more than once, by level-wise doubling of repeated windows.

Only windows that repeat at one length are looked at again at twice the length:

1. *Half length.*  Every window of W words contains W - h + 1 windows of h = ceil(W / 2) words.  The one of
   least hash is picked (all of them on a tie), by content alone, so two equal windows of W words pick equal
   half windows; about one position in ten is picked.  Picked windows are counted over all texts (combined
   before the shuffle), and those that occur once are dropped.
2. *Full length.*  Only windows of W words whose picked half window repeats are candidates.  Their hashes
   are dealt out by hash; a task sends a window that it has met twice already just once, marked so.
   Candidates met once in all are sent back to their texts; every other candidate repeats.

Longer lengths cannot change which words are covered, so doubling ends at W.  Windows are compared by
64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quarry.llm.common import let_go, partitions, texts, texts_key, written
from quarry.llm.words import U, Words, mix, slices, tidy, window_sums

WINDOW = 35
_MAX = U(0xFFFFFFFFFFFFFFFF)


def _rolling(values: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over values[i : i + width], for every i (the tail is padded with the last value's own)."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        nxt = out.copy()
        op(out[:-step], out[step:], out=nxt[:-step])
        out, have = nxt, have + step
    return out


def _picked(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word: hash of the half window it starts (else the largest value), the least such hash in the
    full window it starts, and whether it starts a full window."""
    half = (window + 1) // 2
    n = len(words)
    hashes = np.full(n, _MAX, np.uint64)
    at, h = words.windows(half)
    hashes[at] = h
    room = np.repeat(words.row[1:], words.n_words()) - np.arange(n)
    starts = room >= window
    least = _rolling(hashes, window - half + 1, np.minimum) if n else hashes
    return hashes, least, starts


def _anchors(window: int):
    width = window - (window + 1) // 2 + 1

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                if not len(words):
                    continue
                hashes, least, starts = _picked(words, window)
                best = np.where(starts, least, U(0))
                reach = _rolling(best[::-1], width, np.maximum)[::-1]      # over the windows that hold the word
                at = np.flatnonzero((reach == hashes) & (reach > 0))
                doc = words.doc()[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[at].view(np.int64)), part.column("key").take(pa.array(doc)),
                     pa.array((at - words.row[doc]).astype(np.int64))], names=["half", "key", "pos"])
    return run


def _candidates(part: pa.RecordBatch, window: int) -> tuple[Words, np.ndarray]:
    """The words of the texts, and the starts of full windows whose picked half window repeats."""
    words = Words(part.column("text"))
    n = len(words)
    if not n:
        return words, np.zeros(0, np.int64)
    hashes, least, starts = _picked(words, window)
    pos = part.column("pos")
    flat = pos.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    count = pc.fill_null(pc.list_value_length(pos), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    kept = np.full(n, _MAX, np.uint64)
    at = np.repeat(words.row[:-1], count) + flat
    at = at[at < np.repeat(words.row[1:], count)]       # another text's places, should two keys collide
    kept[at] = hashes[at]
    width = window - (window + 1) // 2 + 1
    return words, np.flatnonzero(starts & (_rolling(kept, width, np.minimum) == least))


def _deal(window: int, buckets: int):
    """Candidate windows as rows (bucket, hashes, keys, starts, many), windows met twice in a batch once."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for part in slices(batch):
                words, at = _candidates(part, window)
                if len(at):
                    doc = words.doc()[at]
                    h = mix(window_sums(words.hash, at, at + window))
                    keys = part.column("key").to_numpy(zero_copy_only=False)[doc]
                    got.append((h, keys, at - words.row[doc]))
            if not got:
                continue
            h, keys, starts = (np.concatenate(x) for x in zip(*got, strict=True))
            h, first, count = np.unique(h, return_index=True, return_counts=True)
            bucket = (h % U(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cut))
            offsets = pa.array(np.append(cut[full], cut[-1]).astype(np.int32))
            listed = lambda x: pa.ListArray.from_arrays(offsets, pa.array(x[order]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), listed(h.view(np.int64)), listed(keys[first]),
                 listed(starts[first].astype(np.int32)), listed(count > 1)],
                names=["bucket", "hashes", "keys", "starts", "many"])
    return run


@tidy
def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by bucket: the windows that stand in one entry alone, met once there."""
    held: list[pa.RecordBatch] = []

    def judge() -> pa.RecordBatch | None:
        col = lambda c: np.concatenate([x.column(c).flatten().to_numpy(zero_copy_only=False) for x in held])
        h, keys, starts, many = (col(c) for c in ("hashes", "keys", "starts", "many"))
        order = np.argsort(h, kind="stable")
        h = h[order]
        new = np.append(True, h[1:] != h[:-1])
        alone = new & np.append(new[1:], True) & ~many[order].astype(bool)
        at = order[alone]
        return pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(starts[at])], names=["key", "start"])

    now = None
    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])), len(buckets))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if held and buckets[lo] != now:
                yield judge()
                held = []
            now = buckets[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield judge()


def _remove(window: int, with_text: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words, at = _candidates(part, window)
                n, rows = len(words), len(part)
                lost = part.column("failed")
                count = pc.fill_null(pc.list_value_length(lost), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                repeats = np.zeros(n + 1, bool)
                repeats[at] = True
                once = np.repeat(words.row[:-1], count) + lost.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                repeats[once[once < np.repeat(words.row[1:], count)]] = False
                edge = np.zeros(n + window + 1, np.int64)
                edge[: n + 1] += repeats
                edge[window:] -= repeats
                gone = np.cumsum(edge)[:n] > 0
                sums = np.append(0, np.cumsum(gone))
                removed = sums[words.row[1:]] - sums[words.row[:-1]]
                raw, keep = words.data.tobytes(), ~gone
                start, end = words.start, words.end
                kept = []
                for i in range(rows):
                    lo, hi = words.row[i], words.row[i + 1]
                    if not removed[i]:
                        kept.append(b" ".join(raw[start[lo]:end[hi - 1]].split()) if hi > lo else b"")
                        continue
                    own = np.flatnonzero(keep[lo:hi]) + lo
                    kept.append(b" ".join([raw[a:b] for a, b in zip(start[own].tolist(), end[own].tolist(), strict=True)]))
                out = [part.column("id"), pa.array(words.n_words().astype(np.int64)), pa.array(removed.astype(np.int64)),
                       pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                names = ["id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    out, names = [*out, part.column("row"), pa.array([x.decode() for x in kept]), part.column("text")], [*names, "row", "kept", "text"]
                yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def _judged(base: DataFrame, window: int) -> DataFrame:
    """The base rows with the places of their repeated half windows (pos) and of candidates that do not repeat (failed)."""
    if window < 2:
        raise ValueError("a window holds two words or more")
    spark = base.sparkSession
    own = base.select("key", "text")
    anchors = own.mapInArrow(_anchors(window), "half long, key long, pos long")
    again = written(anchors.groupBy("half").count().where("count > 1").select("half"), "halves")
    let_go(spark)
    found = written(anchors.join(again, "half", "left_semi").select("key", "pos")
                    .groupBy("key").agg(F.collect_set("pos").alias("pos")), "found")   # per text: its own places
    let_go(spark)
    n = partitions(spark)
    dealt = own.join(found, "key").mapInArrow(
        _deal(window, 4 * n), "bucket int, hashes array<long>, keys array<long>, starts array<int>, many array<boolean>")
    once = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_single, "key long, start int")
    failed = written(once.groupBy("key").agg(F.collect_list("start").alias("failed")), "failed")
    let_go(spark)
    return base.join(found.join(failed, "key", "left"), "key", "left")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_removed`` and ``kept_sha256``, of the kept words
    joined by a space.

    A word goes if a window of ``window`` words covers it whose word sequence also starts elsewhere, in the
    same text or another; all copies go, also the first.  A null or empty text has no words.  Rows that
    repeat an id (or have none) are documents of their own, so a repeated row makes both rows' windows
    repeat.  Other columns of ``docs`` are not looked at.  No text is cut, whatever its length."""
    base = texts(docs, id_col, text_col)
    kind = base.schema["id"].dataType.simpleString()
    out = _judged(base, window).mapInArrow(_remove(window, False), f"id {kind}, n_words long, n_removed long, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns, with the kept words as text; a text that loses nothing stays as it is (also null)."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    base = docs.select(texts_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*rest).alias("row"))
    schema = StructType([base.schema["id"], StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType()),
                         base.schema["row"], StructField("kept", StringType()), base.schema["text"]])
    out = _judged(base, window).mapInArrow(_remove(window, True), schema)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return out.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
