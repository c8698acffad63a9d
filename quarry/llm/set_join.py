"""Exact Jaccard join of word-shingle sets, giving each document its component of linked documents.

Set relations do the skipping, at the level of index lists and at the level of answers:

* *Equal sets* are one class from the start; only classes are joined.
* *Index lists.*  A class enters the lists of its first n - ceil(t n) + 1 shingles under one global order
  (by the counts of a sketch of fixed size, rare first; then by hash).  A list entry holds the set's size
  and the shingle's position, and entries whose sizes or remaining positions rule out enough overlap are
  skipped.  Lists with one class are dropped.
* *Answers.*  Each list has one pivot, the class whose entries stand in the longest lists (of
  a group of edited copies the one nearest to all).  Every entry is compared with the pivot of its lists
  alone; the answers join classes into components.  What is left to compare in a list is derived from the
  pivot's answers: two entries already in one component need no comparison, and as Jaccard distance is a
  metric, two entries whose distances to the pivot differ by more than 1 - t cannot link.  A large group of
  near copies thus costs a few comparisons per member, not all pairs.
* *Comparisons.*  A bit vector of token parities, an eighth of a byte or two per shingle, bounds the symmetric
  difference of two sets from below; whole sets move only for pairs that it leaves open.

Shingles and classes are 64-bit hashes.  The broadcast sketch has a fixed size, whatever the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import forget, fresh, let_go, texts, texts_key, written
from quarry.llm.components import components
from quarry.llm.words import U, Words, mix, slices, tidy, window_sums

SHINGLE = 3
PERCENT = 90
#: Counters of the frequency sketch (4 bytes each) and the parts it is summed in.
SKETCH_BITS = 20
SKETCH_PARTS = 64
#: Keys of texts to fetch, at most, that are broadcast (some 30 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def doc_sets(part: pa.RecordBatch, k: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending; a text of fewer than k words is one shingle, one
    without words is empty."""
    words = Words(part.column("text"), lower=True)
    at, h = words.windows(k)
    cut = np.searchsorted(at, words.row)
    out = [np.unique(h[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    count = words.n_words()
    for i in np.flatnonzero((count > 0) & (count < k)).tolist():
        whole = window_sums(words.hash, words.row[i:i + 1], words.row[i + 1:i + 2])
        out[i] = mix(whole ^ U(int(count[i]) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return out


def _class(tokens: np.ndarray) -> int:
    total = np.array([np.add.reduce(mix(tokens)), len(tokens)], np.uint64)
    return int(mix(total[:1] ^ mix(total[1:])).view(np.int64)[0]) if len(tokens) else 0


def parity(tokens: np.ndarray) -> bytes:
    """One bit per hash value modulo the least power of two not below the set's size (64 at least): whether an
    odd number of tokens fall there."""
    width = 1 << max(6, (len(tokens) - 1).bit_length())
    return np.packbits((np.bincount((tokens & U(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)).tobytes()


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def apart(x: bytes, y: bytes) -> int:
    """A lower bound of the size of the symmetric difference: every token in one set alone flips one bit."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):                       # the finer one is folded to the coarser one's width
        a = a[: len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2:]
    return int(_ONES[a ^ b].sum())


@tidy
def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        low = [apart(x, y) for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(low, pa.int64())], names=["a", "b", "na", "nb", "apart"])


def _scan(k: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["id", "key", "n", "cls", "bits", "part", "counts"]
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            for part in slices(batch):
                sets = doc_sets(part, k)
                if len(part):
                    counts += np.bincount((np.concatenate(sets) >> U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
                none = pa.nulls(len(part), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([_class(x) for x in sets], pa.int64()),
                     pa.array([parity(x) for x in sets], pa.binary()), none, pa.nulls(len(part), pa.binary())], names=names)
        if kind is not None:
            m = SKETCH_PARTS
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()),
                 pa.array(range(m), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in np.split(counts, m)], pa.binary())], names=names)
    return run


@tidy
def _sum_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            x = np.frombuffer(zlib.decompress(raw), np.int64)
            got[part] = got[part] + x if part in got else x
    yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int32()), pa.array([x.tobytes() for x in got.values()], pa.binary())],
                                     names=["part", "counts"])


def _entries(k: int, percent: int, sketch):
    """Index entries (token, cls, n, pos, score); a class that a task meets again is not entered again.  The score
    is the mean of the logarithms of the shingles' sketched counts: of edited copies, the one nearest to all has
    the highest."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sketch.value, set()
        log = np.log2(1 + counts.astype(np.float32))
        for batch in batches:
            for part in slices(batch):
                out = [[], [], [], [], []]
                for tokens in doc_sets(part, k):
                    n, cls = len(tokens), _class(tokens)
                    if not n or cls in seen:
                        continue
                    seen.add(cls)
                    first = n + (-percent * n // 100) + 1
                    slot = (tokens >> U(64 - SKETCH_BITS)).astype(np.int64)
                    chosen = tokens[np.argsort(counts[slot], kind="stable")[:first]]
                    out[0].append(chosen)
                    out[1].append(np.full(first, cls, np.int64))
                    out[2].append(np.full(first, n, np.int32))
                    out[3].append(np.arange(first, dtype=np.int32))
                    out[4].append(np.full(first, log[slot].mean(), np.float32))
                if out[0]:
                    token, cls, n, pos, score = (np.concatenate(x) for x in out)
                    yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(cls), pa.array(n), pa.array(pos), pa.array(score)],
                                                     names=["token", "cls", "n", "pos", "score"])
    return run


def _tokens(k: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for part in slices(batch):
                sets = doc_sets(part, k)
                cls = [_class(x) for x in sets]
                want = part.column("cls").to_pylist()
                rows = []
                for i, (have, asked) in enumerate(zip(cls, want, strict=True)):
                    if have == asked and have not in seen:
                        seen.add(have)
                        rows.append(i)
                if rows:
                    own = part.take(pa.array(rows))
                    offsets = np.append(0, np.cumsum([len(sets[i]) for i in rows])).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [own.column("cls"), own.column("as_a"), own.column("as_b"),
                         pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([sets[i] for i in rows]).view(np.int64)))],
                        names=["cls", "as_a", "as_b", "tokens"])
    return run


def _compared(pairs: DataFrame, base: DataFrame, classes: DataFrame, k: int, t: int) -> DataFrame:
    """The pairs (a, b, na, nb) of classes (cls, key of one text, bits) with ``apart``, a lower bound of their symmetric difference by parity bits, and
    where that leaves a link possible the exact ``overlap`` of their sets."""
    both = lambda x: x.select(F.col("a").alias("cls"), F.lit(True).alias("as_a"), F.lit(False).alias("as_b")).union(
        x.select(F.col("b").alias("cls"), F.lit(False).alias("as_a"), F.lit(True).alias("as_b"))).groupBy("cls").agg(
        F.max("as_a").alias("as_a"), F.max("as_b").alias("as_b"))
    reps = written(classes.join(both(pairs).select("cls"), "cls"), "reps")
    bound = written(pairs.join(reps.select(F.col("cls").alias("b"), F.col("bits").alias("xb")), "b")
                    .join(reps.select(F.col("cls").alias("a"), F.col("bits").alias("xa")), "a")
                    .mapInArrow(_apart, "a long, b long, na int, nb int, apart long"), "bound")
    open_ = bound.where(f"{100 + t} * (na + nb - apart) >= {2 * t} * (na + nb)")
    asked = written(reps.select("cls", "key").join(both(open_), "cls"), "asked")
    forget(reps)
    few = asked.count() <= BROADCAST_ROWS                     # else the texts are shuffled to the keys
    held = written(base.select("key", "text").join(F.broadcast(asked) if few else asked, "key")
                   .mapInArrow(_tokens(k), "cls long, as_a boolean, as_b boolean, tokens array<long>"), "sets")
    forget(asked)
    left = held.where("as_a").select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    right = held.where("as_b").select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    exact = (open_.join(right, "b").join(left, "a")
             .select("a", "b", F.size(F.array_intersect("ta", "tb")).alias("overlap")).distinct())
    out = written(bound.join(exact, ["a", "b"], "left"), "overlaps")
    del left, right, exact, open_
    forget(held, bound)
    return out


def _possible(n1: str, p1: str, n2: str, p2: str, t: int) -> str:
    """Whether sizes and remaining positions leave room for a link."""
    return (f"100 * least({n1}, {n2}) >= {t} * greatest({n1}, {n2}) and "
            f"{100 + t} * (1 + least({n1} - {p1}, {n2} - {p2}) - 1) >= {t} * ({n1} + {n2})")


def _classes(base: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The scanned rows ``(id, key, n, cls)`` and the classes with words ``(cls, c)``, c naming the component."""
    spark = base.sparkSession
    kind = base.schema["id"].dataType.simpleString()
    scanned = written(base.mapInArrow(_scan(shingle), f"id {kind}, key long, n long, cls long, bits binary, part int, counts binary"), "scan")
    sets = scanned.where("part is null").select("id", "key", "n", "cls", "bits")
    parts = (scanned.where("part is not null").select("part", "counts").repartition("part")
             .mapInArrow(_sum_sketch, "part int, counts binary").collect())        # SKETCH_PARTS rows
    counts = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    for row in parts:
        counts[row["part"]] = np.frombuffer(row["counts"], np.int64)
    sketch = spark.sparkContext.broadcast(counts.ravel().astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.int64))   # 4 MB (8 beyond 2**32)

    t = percent
    entries = written(base.select("text").mapInArrow(_entries(shingle, t, sketch), "token long, cls long, n int, pos int, score float"), "entries")
    # Lists of two or more entries; of those with two or more classes the pivot is the class of the highest score.
    lists = written(entries.groupBy("token").count().where("count > 1").select("token"), "lists")
    let_go(spark)
    listed = written(entries.join(lists, "token", "left_semi"), "listed")
    forget(entries, lists)
    pivots = written(listed.groupBy("token").agg(F.max(F.struct("score", "cls", "n", "pos")).alias("p"), F.min("cls").alias("lo"), F.max("cls").alias("hi"))
                     .where("lo != hi").select("token", F.col("p.cls").alias("pcls"), F.col("p.n").alias("pn"), F.col("p.pos").alias("ppos")), "pivots")
    let_go(spark)
    shared = written(listed.drop("score").join(pivots, "token"), "shared")
    forget(listed, pivots)
    star = written(shared.where("cls != pcls").where(_possible("n", "pos", "pn", "ppos", t))
                   .select(F.col("pcls").alias("a"), F.col("cls").alias("b"), F.col("pn").alias("na"), F.col("n").alias("nb")).distinct(), "star")
    # One row per class, merged before the shuffle: the text that stands for it and its parity bits.
    classes = written(sets.where("n > 0").groupBy("cls").agg(F.min("key").alias("key"), F.min("bits").alias("bits")), "classes")
    answers = _compared(star, base, classes, shingle, t)
    linked = F.expr(f"{100 + t} * overlap >= {t} * (na + nb)")
    first = written(components(answers.where(linked), "a", "b"), "first")

    # What the pivots' answers leave open: lists of three or more classes in two or more components.
    dist = F.expr("1 - overlap / (na + nb - overlap)")
    known = answers.select(F.col("a").alias("pcls"), F.col("b").alias("cls"), F.coalesce(dist, F.expr("2 * apart / (na + nb + apart)")).alias("least"),
                           F.coalesce(dist, F.lit(1.0)).alias("most"))
    placed = (shared.select("token", "cls", "n", "pos", "pcls").join(first.withColumnRenamed("node", "cls"), "cls", "left")
              .select("token", "cls", "n", "pos", "pcls", F.coalesce("component", "cls").alias("comp")))
    placed = written(placed, "placed")
    forget(shared)
    mixed = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c")) \
        .where("lo != hi and c > 2").select("token")
    unsettled = written(placed.join(mixed, "token", "left_semi").where("cls != pcls").distinct(), "unsettled")
    del mixed
    forget(placed)
    open_ = written(unsettled.join(known, ["pcls", "cls"], "left").select("token", "cls", "n", "pos", "comp", "least", "most"), "open")
    forget(unsettled)
    x, y = open_.alias("x"), open_.alias("y")
    rest = (x.join(y, (F.col("x.token") == F.col("y.token")) & F.expr("x.cls < y.cls and x.comp != y.comp")
                   & F.expr(_possible("x.n", "x.pos", "y.n", "y.pos", t))
                   & F.expr(f"not coalesce(greatest(x.least - y.most, y.least - x.most) > {1 - t / 100} + 1e-9, false)"))
            .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).distinct())
    done = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = written(rest.join(done, ["a", "b"], "left_anti"), "rest")
    del x, y, done
    forget(open_)
    more = _compared(rest, base, classes, shingle, t).where(linked)
    at = first.select(F.col("node"), F.col("component"))
    lifted = (more.join(at.toDF("a", "ca"), "a", "left").join(at.toDF("b", "cb"), "b", "left")
              .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    second = written(components(lifted, "a", "b"), "second")

    whole = (classes.select("cls").join(first.withColumnRenamed("node", "cls"), "cls", "left").withColumn("c1", F.coalesce("component", "cls")).drop("component")
             .join(second.withColumnRenamed("node", "c1"), "c1", "left").select("cls", F.coalesce("component", "c1").alias("c")))
    whole = written(whole, "components")
    let_go(spark)
    return sets, whole


def shingle_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)``, one row per row of ``docs``.

    Words are runs of non-space, A-Z lower-cased.  Two documents link when 100 * intersection is at least
    ``percent`` * union of their sets of ``shingle``-word shingles; component_id is the least id reachable.  A
    text of fewer words is one shingle; a null or wordless text has an empty set, links with nothing and is
    its own component.  Null ids are passed over when the least id is taken (null if there is no other).
    Repeated rows and repeated ids are rows of their own."""
    sets, classes = _classes(texts(docs, id_col, text_col), shingle, percent)
    own = sets.where("n > 0").groupBy("cls").agg(F.min("id").alias("least"))          # one row per class and task
    own = written(own.join(classes, "cls"), "own")
    least = written(own.groupBy("c").agg(F.min("least").alias("component_id")), "least")
    place = written(own.join(least, "c").select("cls", "component_id"), "place")
    let_go(docs.sparkSession)
    return (sets.join(place, "cls", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns, without those that link, directly or through others, with a row of smaller id
    (null ids last; equal ids by a hash of the text).  Of rows that repeat id and text one stays; rows without
    words all stay."""
    sets, classes = _classes(texts(docs, id_col, text_col), shingle, percent)
    rank = F.struct(F.col("id").isNull(), "id", "key")
    own = written(sets.where("n > 0").groupBy("cls").agg(F.min(rank).alias("first")).join(classes, "cls"), "own")
    best = written(own.groupBy("c").agg(F.min("first").alias("first")), "best")
    place = written(own.select("cls", "c").join(best, "c").select("cls", F.col("first.key").alias("stays")), "place")
    words = sets.where("n > 0").join(place, "cls")
    name = fresh("_key", docs.columns)
    gone = written(words.where("key != stays").select(F.col("key").alias(name)).distinct(), "gone")
    again = written(words.where("key = stays").groupBy(F.col("key").alias(name)).agg(F.count("*").alias("n")).where("n > 1").select(name), "again")
    let_go(docs.sparkSession)
    keyed = docs.withColumn(name, texts_key(id_col, text_col))
    left = keyed.join(gone, name, "left_anti")
    if not again.isEmpty():
        left = left.join(again, name, "left_anti").unionByName(left.join(again, name, "left_semi").dropDuplicates([name]))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
