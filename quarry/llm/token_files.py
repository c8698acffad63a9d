"""Token-id files: documents encoded, packed into Re-Pair shards in document order, and read back.

The files are a Parquet dataset with a row per shard: ``part`` and ``shard`` (place in the order), ``before``
(ids of the part that stand before the shard), ``ids`` (the documents), ``counts`` (their numbers of ids),
``tokens`` and ``payload`` (see ``repair``).  Spark's writer commits them, so a lost executor leaves no half
file, on any file system that Spark reaches.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import in_order, shared_dir
from quarry.llm.repair import Shard, compress
from quarry.llm.tokens import ENCODE_BYTES, WordTokenizer
from quarry.llm.words import slices, tidy

END = 1
#: Ids per shard, about (a document is never split between shards).
SHARD_IDS = 1 << 20


def _encode(path: str | None, end: int, shard_ids: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(path)
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def pack() -> pa.RecordBatch:
            nonlocal shard, before
            counts = np.concatenate([c for _, c, _ in held])
            ids = np.concatenate([x for _, _, x in held])
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([shard], pa.int64()), pa.array([before], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.concat_arrays([d for d, _, _ in held])),
                 pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()),
                 pa.array([compress(ids, np.cumsum(counts))], pa.binary())],
                names=["part", "shard", "before", "ids", "counts", "tokens", "payload"])
            shard, before = shard + 1, before + len(ids)
            held.clear()
            return row

        total = 0
        for batch in batches:
            for some in slices(batch, size=ENCODE_BYTES):
                flat, bounds = tokenizer.encode(some.column("text"))
                counts = np.diff(bounds) + 1
                ids = np.insert(flat, bounds[1:], end)
                cut = np.append(0, np.cumsum(counts))
                at = 0
                while at < len(counts):
                    to = max(at + 1, int(np.searchsorted(cut, cut[at] + shard_ids - total, side="right")) - 1)
                    to = min(to, len(counts))
                    held.append((some.column("id").slice(at, to - at), counts[at:to], ids[cut[at]:cut[to]]))
                    total += int(cut[to] - cut[at])
                    if total >= shard_ids or to < len(counts):
                        yield pack()
                        total = 0
                    at = to
        if held:
            yield pack()
    return run


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END, shard_ids: int = SHARD_IDS,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every whole text (null: empty), appends ``end`` to each, and writes shards in ascending id order
    (null ids first; equal ids by text, and an id with many rows spans tasks).  An empty table gives files without
    rows."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    ordered = in_order(base)
    (ordered.mapInArrow(_encode(vocabulary, end, shard_ids),
                        f"part long, shard long, before long, ids array<{kind}>, counts array<long>, tokens long, payload binary")
     .write.parquet(path))


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document, decoded from the files: id, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` (of its ids as little-endian unsigned 32-bit numbers), and with ``with_ids``
    the ids themselves."""
    files = spark.read.parquet(path)
    parts = files.groupBy("part").agg(F.sum("tokens").alias("n"))                      # a row per task that wrote
    begin = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("begin"))
    kind = files.schema["ids"].dataType.elementType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                row = batch.slice(r, 1)
                counts = np.array(row.column("counts")[0].as_py(), np.int64)
                ids = Shard(row.column("payload")[0].as_py()).ids().astype("<u4")
                cut = np.append(0, np.cumsum(counts))
                first = row.column("begin")[0].as_py() + row.column("before")[0].as_py()
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                out = [row.column("ids").flatten(), pa.array(first + cut[:-1]), pa.array(counts), pa.array(crc, pa.int64())]
                names = ["id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    out, names = [*out, pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(ids.astype(np.int64)))], [*names, "token_ids"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return (files.select("part", "before", "ids", "counts", "payload").join(F.broadcast(begin), "part")
            .mapInArrow(run, f"id {kind}, start long, n_tokens long, ids_crc32 long" + (", token_ids array<long>" if with_ids else ""))
            .withColumnRenamed("id", id_col))


def token_files(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files into the shared folder and reads them back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/quarry-tokens-{uuid.uuid4().hex}"
    write_token_files(docs, path, vocabulary, id_col=id_col, text_col=text_col)
    return read_token_files(spark, path, id_col)
