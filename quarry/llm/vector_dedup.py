"""Near-duplicate vectors by spherical k-means cells, blocked cosine products, and components.

Vectors of one label (and dimension) are assigned to cells by the most similar of the label's centres.  A
vector is compared in its home cell; a neighbour also stands, as a guest, in every other cell whose border is
so near that a partner at the least cosine may live there: y visits cell c if

    y . (c_y - c)  <=  sin(t) * |c_y - c|,   t = the angle of the least cosine.

A partner x at home in c has x . (c_y - c) <= 0, so y lies at an angle of at most t from the border's plane: no
link is missed, however the vectors are spread.  Either end of a link may visit the other, so of two cells one
alone takes guests from the other, and a link found there counts for both ends.  Centres decide what is compared, never what is found; vectors
without clusters visit most cells, at a cost up to that of all pairs.  Inside a cell the vectors within half
the linking angle of the centre (the ball) are all linked by the triangle inequality and are counted, not
compared; so a group of near-equal vectors, however large, costs one count.  Everything else is compared by
matrix products of at most CHUNK home vectors with blocks of partners, and a task emits a link count per home
vector and a spanning forest of what it linked, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import let_go, written
from quarry.llm.components import components
from quarry.llm.words import tidy

LEAST_COSINE = 0.93
#: Vectors per cell, about; centres in all, at most (beyond it cells grow); sampled vectors and
#: seeds to choose from per centre; largest cosine of two centres; vectors multiplied at once.
CELL = 2000
MAX_CENTRES = 16_384
SAMPLE_PER_CENTRE = 32
SEEDS_PER_CENTRE = 4
APART = 0.9
BLOCK = 1024
ROUNDS = 8
CHUNK = 2048
HOME, SAME, GUEST = 0, 1, 2


@tidy
def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a label and a finite vector other than zero, as unit vectors in double precision."""
    for batch in batches:
        col = batch.column("embedding")
        rows, units = [], []
        label_ok = np.array(batch.column("label").is_valid())
        for i, v in enumerate(col):
            if not (label_ok[i] and v.is_valid) or v.values.null_count or not len(v.values):
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            top = np.abs(x).max()
            if np.isfinite(top) and top > 0:
                x = x / top
                rows.append(i)
                units.append((x / np.linalg.norm(x)).tobytes())
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("key").take(at), batch.column("label").take(at).cast(pa.string()),
                                          pa.array([len(u) // 8 for u in units], pa.int32()), pa.array(units, pa.binary())],
                                         names=["key", "label", "dim", "unit"])


def _seeds(points: np.ndarray, k: int, apart: float) -> np.ndarray:
    """At most k of the points, no two with a cosine of ``apart`` or more."""
    chosen = [points[0]]
    best = points @ points[0]
    for i in range(1, len(points)):
        if len(chosen) == k:
            break
        if best[i] < apart:
            chosen.append(points[i])
            best = np.maximum(best, points @ points[i])
    return np.array(chosen)


def _sums(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The sum of the points of each centre, by blocks of points."""
    sums = np.zeros_like(centres)
    for at in range(0, len(points), BLOCK):
        some = points[at:at + BLOCK]
        np.add.at(sums, (some @ centres.T).argmax(axis=1), some)
    return sums


def _moved(centres: np.ndarray, sums: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(sums, axis=1)
    return np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)


def _apart(centres: np.ndarray, apart: float) -> np.ndarray:
    kept, n = np.zeros_like(centres), 0
    for c in centres:
        if (kept[:n] @ c <= apart).all():
            kept[n], n = c, n + 1
    return kept[:n]


def spherical_kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS, apart: float = APART) -> np.ndarray:
    """At most k unit centres, no two with a cosine above ``apart`` (so a dense group keeps one centre)."""
    centres = _seeds(points, k, apart)
    for _ in range(rounds):
        centres = _moved(centres, _sums(points, centres))
    return _apart(centres, apart)


def _partial(held):
    """A task's sums of its vectors by centre."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        for batch in batches:
            groups: dict[tuple, list[int]] = {}
            for i, g in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True)):
                groups.setdefault(g, []).append(i)
            units = batch.column("unit").to_pylist()
            for g, rows in groups.items():
                sums = _sums(np.frombuffer(b"".join(units[i] for i in rows)).reshape(len(rows), g[1]), held.value[g])
                total[g] = total[g] + sums if g in total else sums
        for (label, dim), sums in total.items():
            for c in np.flatnonzero(np.any(sums != 0, axis=1)).tolist():
                yield pa.RecordBatch.from_arrays([pa.array([label]), pa.array([dim], pa.int32()), pa.array([c], pa.int32()), pa.array([sums[c].tobytes()], pa.binary())],
                                                 names=["label", "dim", "c", "total"])
    return run


def _added(rows: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x) for x in rows.column("total").to_pylist()], axis=0)
    return rows.slice(0, 1).set_column(3, "total", pa.array([total.tobytes()], pa.binary()))


def _centres(units: DataFrame, cell: int) -> dict[tuple[str, int], np.ndarray]:
    """Centres of every (label, dimension) with more than one cell.  The rounds run as jobs over SAMPLE_PER_CENTRE
    vectors a centre; the driver holds SEEDS_PER_CENTRE of them, and the centres."""
    sizes = units.groupBy("label", "dim").agg(F.count("*").alias("n")).withColumn("total", F.lit(units.count()))
    sizes = sizes.withColumn("k", F.ceil(F.col("n") / F.greatest(F.lit(float(cell)), F.col("total") / MAX_CENTRES))).where("k > 1")
    want = sizes.withColumn("share", F.col("k") * SAMPLE_PER_CENTRE / F.col("n")).select("label", "dim", "k", "share")
    place = F.pmod(F.xxhash64("key", F.lit(7)), F.lit(1 << 20)) / (1 << 20)
    drawn = written(units.join(F.broadcast(want), ["label", "dim"])           # at most MAX_CENTRES rows: each has a centre
                    .where(place < F.col("share")).select("label", "dim", "k", "unit", "key", (place / F.least("share", F.lit(1.0))).alias("place")), "sample")
    groups: dict[tuple[str, int], tuple[int, list]] = {}
    for r in drawn.where(F.col("place") < SEEDS_PER_CENTRE / SAMPLE_PER_CENTRE).collect():
        groups.setdefault((r["label"], r["dim"]), (r["k"], []))[1].append((r["key"], np.frombuffer(r["unit"])))
    centres = {g: _seeds(np.array([v for _, v in sorted(x, key=lambda t: t[0])]), k, APART) for g, (k, x) in groups.items()}
    if not centres:
        return centres
    taught = drawn.join(F.broadcast(drawn.sparkSession.createDataFrame(list(centres), "label string, dim int")), ["label", "dim"])
    for _ in range(ROUNDS):
        held = units.sparkSession.sparkContext.broadcast(centres)
        sums = {g: np.zeros_like(c) for g, c in centres.items()}
        for r in (taught.select("label", "dim", "unit").mapInArrow(_partial(held), "label string, dim int, c int, total binary")
                  .groupBy("label", "dim", "c").applyInArrow(_added, "label string, dim int, c int, total binary").toLocalIterator()):
            sums[r["label"], r["dim"]][r["c"]] = np.frombuffer(r["total"])
        centres = {g: _moved(c, sums[g]) for g, c in centres.items()}
        held.destroy()
    return {g: _apart(c, APART) for g, c in centres.items()}


def _assign(held, far: float, tight: float):
    """The vectors once each, with the cells they are guests of: (cell, key, unit, ball, visits)."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = held.value
        for batch in batches:
            out: list[tuple] = []
            groups: dict[tuple, list[int]] = {}
            for i, g in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True)):
                groups.setdefault(g, []).append(i)
            keys, units = batch.column("key").to_pylist(), batch.column("unit").to_pylist()
            for (label, dim), rows in groups.items():
                own = centres.get((label, dim))
                if own is None or len(own) < 2:
                    out.extend((f"{label}|{dim}|0", keys[i], units[i], False, []) for i in rows)
                    continue
                x = np.frombuffer(b"".join(units[i] for i in rows)).reshape(len(rows), dim)
                like = x @ own.T
                home = like.argmax(axis=1)
                top = like[np.arange(len(rows)), home]
                between = np.sqrt(np.maximum(2 - 2 * own @ own.T, 0))
                visits = top[:, None] - like <= far * between[home] + 1e-9
                cell = np.arange(len(own))
                visits &= (cell < home[:, None]) == ((cell + home[:, None]) % 2 == 0)      # of two cells one is the host
                visits[np.arange(len(rows)), home] = False
                for r, i in enumerate(rows):
                    out.append((f"{label}|{dim}|{home[r]}", keys[i], units[i], bool(top[r] >= tight), [f"{label}|{dim}|{c}" for c in np.flatnonzero(visits[r])]))
            if out:
                cell, key, unit, ball, guest_of = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(key, pa.int64()), pa.array(unit, pa.binary()), pa.array(ball), pa.array(guest_of, pa.list_(pa.string()))],
                                                 names=["cell", "key", "unit", "ball", "visits"])
    return run


def _compare(least: float, chunk: int):
    """Of rows sorted by (cell, chunk, partner), partner being HOME, SAME for a partner of the same cell or GUEST:
    link counts of home vectors and guests, and spanning edges (key, links, other)."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, home_keys, home, links, label = None, [], [], None, None

        def ready() -> None:
            nonlocal home, home_keys, links, label
            if links is None:
                home = np.concatenate([h for h in home]) if home else np.zeros((0, 1))
                home_keys = np.concatenate(home_keys) if home_keys else np.zeros(0, np.int64)
                links, label = np.zeros(len(home_keys), np.int64), home_keys.copy()

        def block(keys: np.ndarray, x: np.ndarray, guests: bool) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
            """Counts links with a block of partners; returns spanning edges, and the counts of guests, met nowhere else."""
            if not len(home_keys):
                return [], []
            hit = home @ x.T >= least
            hit &= home_keys[:, None] != keys[None, :]
            links[:] += hit.sum(axis=1)
            h, p = np.nonzero(hit)
            if not len(h):
                return [], []
            theirs = hit.sum(axis=0) if guests else np.zeros(0, np.int64)
            counts = [(int(keys[i]), int(theirs[i])) for i in np.flatnonzero(theirs)]
            before, mine = label.copy(), keys.copy()
            while True:
                old = mine.copy()
                np.minimum.at(mine, p, label[h])
                np.minimum.at(label, h, mine[p])
                if (old == mine).all() and (label[h] <= mine[p]).all():
                    break
            moved, joined = before != label, keys != mine
            return list(zip(before[moved].tolist(), label[moved].tolist(), strict=True)) + list(zip(keys[joined].tolist(), mine[joined].tolist(), strict=True)), counts

        def rows(edges: list[tuple[int, int]], counts: list[tuple[int, int]]) -> pa.RecordBatch | None:
            a = [(k, n, None) for k, n in counts]
            a += [(x, None, y) for x, y in set(edges)]
            if not a:
                return None
            key, n, other = zip(*a, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(other, pa.int64())], names=["key", "links", "other"])

        for batch in batches:
            cells, chunks = batch.column("cell").to_pylist(), batch.column("chunk").to_pylist()
            partner = batch.column("partner").to_numpy()
            keys = batch.column("key").to_numpy()
            units = batch.column("unit")
            marks = list(zip(cells, chunks, partner.tolist(), strict=True))
            at = 0
            while at < len(marks):
                to = at + 1
                while to < len(marks) and marks[to] == marks[at] and to - at < chunk:
                    to += 1
                if marks[at][:2] != now:
                    if now is not None:
                        ready()
                        done = rows([], list(zip(home_keys.tolist(), links.tolist(), strict=True)))
                        if done is not None:
                            yield done
                    now, home_keys, home, links, label = marks[at][:2], [], [], None, None
                x = np.frombuffer(b"".join(units.slice(at, to - at).to_pylist())).reshape(to - at, -1)
                if partner[at] == HOME:
                    home.append(x)
                    home_keys.append(keys[at:to])
                else:
                    ready()
                    done = rows(*block(keys[at:to], x, partner[at] == GUEST))
                    if done is not None:
                        yield done
                at = to
        if now is not None:
            ready()
            done = rows([], list(zip(home_keys.tolist(), links.tolist(), strict=True)))
            if done is not None:
                yield done
    return run


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE, cell: int = CELL, chunk: int = CHUNK,
                 id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Two rows link when their labels are equal and not null, their vectors have one length and their cosine, in
    double precision, is at least ``least``.  Null, empty, zero and non-finite vectors and those with null
    components link with nothing.  component_id is the least id reachable, null ids passed over; kept where it
    is the row's own id.  Repeated rows are vectors of their own and link with each other.  All pairs of at
    least ``least`` are found."""
    spark = vectors.sparkSession
    table = written(vectors.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"),
                                   F.col(vector_col).cast("array<double>").alias("embedding"), F.col(label_col).alias("label")), "vectors")
    units = written(table.select("key", "embedding", "label").mapInArrow(_unit, "key long, label string, dim int, unit binary"), "units")
    centres = spark.sparkContext.broadcast(_centres(units, cell))          # MAX_CENTRES vectors at most
    far, tight = math.sin(math.acos(min(1.0, max(0.0, least)))), math.cos(math.acos(least) / 2) + 1e-12
    members = written(units.mapInArrow(_assign(centres, far, tight), "cell string, key long, unit binary, ball boolean, visits array<string>"), "members")
    stats = written(members.groupBy("cell").agg(F.count_if(~F.col("ball")).alias("loose"), F.count_if("ball").alias("balls"),
                                                F.min(F.when(F.col("ball"), F.col("key"))).alias("ball_root"))
                    .select("cell", F.ceil(F.col("loose") / chunk).cast("int").alias("a"), F.ceil(F.col("balls") / chunk).cast("int").alias("b"),
                            "balls", "ball_root"), "cells")
    placed = members.join(stats, "cell")
    guests = members.where(F.size("visits") > 0).select(F.explode("visits").alias("cell"), "key", "unit").join(stats, "cell")
    spread = F.pmod(F.xxhash64("key", F.lit(3)), F.greatest(F.when(F.col("ball"), F.col("b")).otherwise(F.col("a")), F.lit(1))).cast("int")
    homes = placed.select("cell", (spread + F.when(F.col("ball"), F.col("a")).otherwise(0)).alias("chunk"), F.lit(HOME).alias("partner"), "key", "unit")

    def meet(rows: DataFrame, chunks: Column, kind: int) -> DataFrame:
        return rows.where(chunks > 0).select("cell", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.lit(kind).alias("partner"), "key", "unit")

    every = F.col("a") + F.col("b")
    partners = meet(placed, F.when(F.col("ball"), F.col("a")).otherwise(every), SAME).union(meet(guests, every, GUEST))   # a ball's vectors are not compared with each other
    found = written(homes.union(partners).repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "partner")
                    .mapInArrow(_compare(least, chunk), "key long, links long, other long"), "links")
    let_go(spark)
    balls = placed.where("ball").select("key", (F.col("balls") - 1).alias("links"), F.col("ball_root").alias("other"))
    counts = found.where("links is not null").select("key", "links").union(balls.select("key", "links")).groupBy("key").agg(F.sum("links").alias("n_links"))
    edges = found.where("other is not null").select("key", "other").union(balls.select("key", "other"))
    parts = written(components(edges, "key", "other"), "parts").withColumnRenamed("node", "key")
    rows = written(table.select("key", "id").join(counts, "key", "left").join(parts, "key", "left")
                   .select("key", "id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "key").alias("c")), "rows")
    least_id = written(rows.groupBy("c").agg(F.min("id").alias("component_id")), "least")
    let_go(spark)
    return rows.join(least_id, "c").select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
