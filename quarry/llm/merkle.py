"""Merkle manifest of a table: a postorder append log, and proofs whose siblings are addressed in closed form.

Rows are leaves of one tree per group (``FAN`` children a node); the groups' roots are the leaves of a last tree.
Each tree is cut into aligned blocks of ``SPAN`` leaves.  A builder takes one block and appends its nodes in
completion order (postorder): a leaf, then every node which that leaf completes.  The blocks' roots are the leaves
of the next round, until one block holds a whole tree, so no task ever sees more than ``SPAN`` leaves of a tree
and a group of any size is spread over all tasks.

A node's place in the log follows from subtree sizes alone (``place``): what stands before it are the nodes
completed by earlier leaves, and its own subtree.  Proofs are read from the log with it, from the last round down:
the path of a block's root is handed to the block's leaves, so an upper path is worked out once per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import small_batches, written
from quarry.llm.words import tidy

FAN = 3
#: Levels in a block, and its leaves.
DEPTH = 6
SPAN = FAN**DEPTH
#: Blocks in an Arrow batch (a block with its digests is some 60 KB).
BATCH_BLOCKS = 100
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def place(level: int, index: int, leaves: int) -> int:
    """Postorder position of the node ``index`` of ``level`` (leaves: 0) in a tree of so many leaves.

    With c leaves to its left, the nodes completed before its first leaf are c + c div 3 + c div 9 + ...;
    then comes its own subtree, whose levels hold m, ceil(m / 3), ceil(m / 9), ... nodes, itself the last."""
    left = index * FAN**level
    own = min(FAN**level, leaves - left)
    at = -1
    while left:
        at += left
        left //= FAN
    for _ in range(level + 1):
        at += own
        own = -(-own // FAN)
    return at


def height(leaves: int, whole: bool = True) -> int:
    """Levels above the leaves: until one node is left, or those of a block inside a larger tree."""
    h = 0
    while h < DEPTH and (not whole or FAN**h < leaves):
        h += 1
    return h


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def append_nodes(leaves: list[str], levels: int) -> list[str]:
    """The log of one block: each leaf, followed by the nodes it completes; what is left open closes at the end."""
    log: list[str] = []
    runs: list[list[str]] = [[] for _ in range(levels + 1)]

    def close(level: int) -> None:
        log.append(digest("".join(runs[level])))
        runs[level + 1].append(log[-1])
        runs[level].clear()

    for leaf in leaves:
        log.append(leaf)
        runs[0].append(leaf)
        level = 0
        while level < levels and len(runs[level]) == FAN:
            close(level)
            level += 1
    for level in range(levels):
        if runs[level]:
            close(level)
    return log


def block_paths(nodes: list[str], leaves: int, levels: int, tail: list[tuple[str, str]]) -> list[tuple]:
    """For each leaf of a block its path as linked ``(siblings to the left, to the right, path of the parent)``."""
    above: tuple = ()
    for left, right in reversed(tail):
        above = (left, right, above)
    paths = [above]
    for level in range(levels - 1, -1, -1):
        size = -(-leaves // FAN**level)
        row = [nodes[place(level, j, leaves)] for j in range(size)]
        paths = [("".join(row[j - j % FAN:j]), "".join(row[j + 1:j - j % FAN + FAN]), paths[j // FAN]) for j in range(size)]
    return paths


def steps(path: tuple) -> Iterator[tuple[str, str]]:
    while path:
        yield path[0], path[1]
        path = path[2]


def fold(leaf: str, path: tuple) -> str:
    """The root that a leaf and its path give."""
    for left, right in steps(path):
        leaf = digest(left + leaf + right)
    return leaf


def field(c: Column) -> Column:
    """A value as hashed: ``-`` if null, else its UTF-8 byte count, a colon, and the value."""
    text = c.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digests(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
                 tampered: dict[str, Column] | None = None) -> DataFrame:
    """``(grp, id, hash, changed)``: every row's leaf, and its leaf with the columns of ``tampered`` in place of
    its own (null where no hashed column differs).  ``grp`` orders null before all strings."""
    def leaf(columns: dict[str, Column]) -> Column:
        return F.unhex(F.sha2(F.concat(*[field(columns.get(c, F.col(c))) for c in fields]), 256))

    differs = F.lit(False)
    for name, value in (tampered or {}).items():
        differs = differs | ~value.eqNullSafe(F.col(name))
    group = F.col(group_col).cast("string")
    return docs.select(F.when(group.isNull(), "0").otherwise(F.concat(F.lit("1"), group)).alias("grp"), F.col(id_col).alias("id"),
                       leaf({}).alias("hash"), F.when(differs, leaf(tampered or {})).alias("changed"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``idx``, their place in their group by ``order``, and ``n``, the group's size.

    Rows are dealt by range, so a large group spans tasks; each range counts its own, and what is summed over
    ranges is a row per group and range."""
    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    table = written(ordered.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ordered")
    counts = table.groupBy(group, "_part").agg(F.min("_at").alias("_lo"), F.count("*").alias("_n"))
    to_here = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select(group, "_part", (F.sum("_n").over(to_here) - F.col("_n") - F.col("_lo")).alias("_shift"),
                           F.sum("_n").over(Window.partitionBy(group)).alias("n"))
    return table.join(starts, [group, "_part"]).withColumn("idx", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


@tidy
def _append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        logs = []
        for leaves, n in zip(batch.column("leaves").to_pylist(), batch.column("n").to_pylist(), strict=True):
            log = append_nodes([x.hex() for x in leaves], height(len(leaves), n <= SPAN))
            logs.append(bytes.fromhex("".join(log)))
        keep = [i for i, name in enumerate(batch.schema.names) if name != "leaves"]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], pa.array(logs, pa.binary())], names=[*[batch.schema.names[i] for i in keep], "nodes"])


@dataclass
class Log:
    """The segments of each round: ``(grp, block, n, size, ids, changed, nodes)``, a row per block; ``nodes`` are the
    block's digests in postorder, 32 bytes each.  A block's root is the last of them."""

    rounds: list[DataFrame]

    def roots(self) -> DataFrame:
        """``(grp, hash)``: each tree's root, from the round in which one block holds the tree."""
        out = [r.where(F.col("n") <= SPAN).select("grp", F.substring("nodes", -32, 32).alias("hash")) for r in self.rounds]
        for more in out[1:]:
            out[0] = out[0].unionAll(more)
        return out[0]


def append_log(leaves: DataFrame, name: str) -> Log:
    """Trees over ``(grp, idx, n, hash, id, changed)``, round by round; the number of rounds is the logarithm of the
    largest group to the base ``SPAN``."""
    rounds = []
    while True:
        blocks = (leaves.groupBy("grp", F.expr(f"idx div {SPAN}").alias("block"), "n")
                  .agg(F.array_sort(F.collect_list(F.struct("idx", "hash", "id", "changed"))).alias("rows"))
                  .select("grp", "block", "n", F.size("rows").alias("size"), F.col("rows.hash").alias("leaves"),
                          F.col("rows.id").alias("ids"), F.col("rows.changed").alias("changed")))
        kinds = ", ".join(f"{c} {blocks.schema[c].dataType.simpleString()}" for c in blocks.columns if c != "leaves")
        rounds.append(written(blocks.mapInArrow(_append, f"{kinds}, nodes binary"), f"{name}-{len(rounds)}"))
        parts = rounds[-1].where(F.col("n") > SPAN)
        if parts.isEmpty():
            return Log(rounds)
        leaves = parts.select("grp", F.col("block").alias("idx"), F.expr(f"(n + {SPAN - 1}) div {SPAN}").alias("n"),
                              F.substring("nodes", -32, 32).alias("hash"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("binary").alias("changed"))


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[dict, list[str], list[tuple]]]:
    """Of each block: its columns, its leaves, and their paths, read from the log at their places."""
    for row in batch.to_pylist():
        m, raw = row["size"], row["nodes"].hex()
        nodes = [raw[k:k + 64] for k in range(0, len(raw), 64)]
        tail = [tuple(x.split(",")) for x in row["path"].split(";") if x]
        yield row, [nodes[place(0, j, m)] for j in range(m)], block_paths(nodes, m, height(m, row["n"] <= SPAN), tail)


def _written_path(path: tuple) -> str:
    return ";".join(",".join(s) for s in steps(path))


@tidy
def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, leaves, paths in _segments(batch):
            m, first = len(leaves), row["block"] * SPAN
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["grp"]] * m, pa.string()), pa.array(range(first, first + m), pa.int64()), pa.array([row["subroot"]] * m, pa.string()),
                 pa.array([_written_path(p) for p in paths], pa.string())], names=["grp", "block", "subroot", "path"])


@tidy
def _to_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, leaves, paths in _segments(batch):
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.string()), pa.array(leaves, pa.string()), pa.array([_written_path(p) for p in paths], pa.string())],
                                             names=["grp", "subroot", "path"])


@tidy
def _to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind = batch.schema.field("ids").type.value_type
        for row, leaves, paths in _segments(batch):
            proof = [digest("".join(a + b for a, b in steps(p))) for p in paths]
            folded = [fold(y.hex() if y else x, p) for x, y, p in zip(leaves, row["changed"], paths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], kind), pa.array(leaves, pa.string()), pa.array([row["subroot"]] * len(leaves), pa.string()),
                 pa.array(proof, pa.string()), pa.array(folded, pa.string())], names=["id", "leaf", "subroot", "proof_sha256", "folded_root"])


def with_paths(log: Log, tops: DataFrame) -> DataFrame:
    """The lowest round's blocks with the path of each block's root, handed down from ``tops``
    ``(grp, subroot, path)``, the paths of the trees' roots."""
    above = None
    for r in range(len(log.rounds) - 1, -1, -1):
        table = log.rounds[r]
        rows = table.where(F.col("n") <= SPAN).join(tops, "grp")
        if above is not None:
            rows = rows.unionByName(table.where(F.col("n") > SPAN).join(above, ["grp", "block"]))
        if r:
            above = rows.mapInArrow(_to_blocks, "grp string, block long, subroot string, path string")
    return rows


def manifest_proofs(docs: DataFrame, tampered: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS,
                    id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """One row per document: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (digest of the proof's siblings from
    the leaf's run up to the root, left to right), ``folded_root`` (what the tampered leaf, or else the own one, gives
    with that proof) and ``verified``.

    Nulls in any column are hashed as ``-``; a null group is a tree of its own and the first.  Rows of equal id stand
    by their leaf; rows that repeat altogether are leaves of their own, in one range.  Empty and long texts are hashed
    whole.  An empty table gives no rows.  Other columns of ``docs`` are not read."""
    small_batches(docs.sparkSession, BATCH_BLOCKS)
    leaves = written(leaf_digests(docs, fields, id_col, group_col, tampered), "leaves")
    log = append_log(numbered(leaves, "grp", ["id", "hash"]), "log")
    roots = log.roots().select(F.lit("").alias("grp"), F.col("grp").alias("id"), "hash", F.lit(None).cast("binary").alias("changed"))
    top = append_log(numbered(roots, "grp", ["id"]), "top")
    root = [r["hash"].hex() for r in top.roots().collect()]                     # one row, or none of an empty table
    last = top.rounds[-1].where(F.col("n") <= SPAN).select("grp", F.lit("").alias("subroot"), F.lit("").alias("path"))
    tops = with_paths(top, last).mapInArrow(_to_groups, "grp string, subroot string, path string")
    kind = leaves.schema["id"].dataType.simpleString()
    out = with_paths(log, tops).mapInArrow(_to_rows, f"id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")
    whole = F.lit(root[0] if root else None).cast("string")
    return out.select(F.col("id").alias(id_col), "leaf", "subroot", whole.alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == whole).alias("verified"))


def without_line_feeds(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """The tampering of the query: line feeds are deleted from texts whose id, in decimal, has an even crc32."""
    even = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 2 == 0, F.lit(False))
    return {text_col: F.when(even, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col))}
