"""The nearest of many centres (C3 with the centres as a table).

The rule is ``kmeans.nearest``'s: least squared distance in double, the lowest index on ties.  The integer
plane is cut into square cells of a side that halves twice from level to level.  Cells of points and cells of
centres are taken down together, each cell of centres with one of its centres.  Of those the nearest to the middle of a
cell of points is that cell's pivot, and a pair of cells stays only while some place of the one may be as near to a place
of the other as to the pivot.  How much farther the pivot is than a stretch is convex along each axis, so
the cell's corners decide, and far-off cells keep no more pairs than near ones.  Each level joins the pairs with the
children of the centres' cells, prunes, joins what stays with the children of the points' cells, and prunes by their own
pivots; the centres of the remaining lowest cells are pruned alike.  A lowest cell's few centres are one list, so that a
point meets one row and no point is grouped or sorted by itself.  Where more centres than a list takes may be nearest to
one cell, its points go on to smaller cells, down to single places.  There is no product of points and centres at any size.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.kmeans import squared_distance
from quarry.session import cut_lineage, release

#: Bits of a coordinate that one level adds; centres that a lowest cell holds, about.
LEVEL_BITS = 2
CELL_CENTRES = 2
#: Centres that a cell's list takes; cells with more are cut further.
LIST_MOST = 64
#: Bounds are compared with this much room, as squares beyond 2**53 are rounded.
ROOM = 1e-12


def _cell(c: str, bits: int) -> Column:
    return F.shiftright(F.col(c).cast("long"), bits)                   # floors negative coordinates as well


def _stretch(c: str, side: int) -> tuple[Column, Column]:
    low = F.col(c).cast("double") * side
    return low, low + (side - 1)


def _excess(places: tuple[Column, Column], pivot: str, other: tuple[Column, Column]) -> Column:
    """On one axis, the most by which a place's square distance from the pivot exceeds the one from the other stretch."""
    def at(p: Column) -> Column:
        gap = F.greatest(other[0] - p, p - other[1], F.lit(0.0))
        return F.pow(p - F.col(pivot), 2) * (1 + ROOM) - F.pow(gap, 2)         # no operand twice: the generated code stays short
    return F.greatest(at(places[0]), at(places[1]))


def _may_hold(side: int, x: tuple[Column, Column], y: tuple[Column, Column]) -> Column:
    """Whether a place of the cell (ax, ay) may be as near to the box of x and y as to the pivot (px, py)."""
    return _excess(_stretch("ax", side), "px", x) + _excess(_stretch("ay", side), "py", y) >= 0


def _pruned(pairs: DataFrame, side: int, x: tuple[Column, Column], y: tuple[Column, Column], *above: str) -> DataFrame:
    """Pairs whose box may hold the nearest centre of a place of (ax, ay), with that cell's pivot (px, py) out of the
    centres (cx, cy).  Pairs that lie together by the cell ``above`` stay where they are."""
    middle = [F.col(a).cast("double") * side + (side - 1) / 2 for a in ("ax", "ay")]
    d = squared_distance(*middle, F.col("cx"), F.col("cy"))
    best = F.min(F.struct(d.alias("d"), "cx", "cy")).over(Window.partitionBy(*above, "ax", "ay"))
    pivoted = pairs.withColumn("_p", best).withColumns({"px": F.col("_p.cx").cast("double"), "py": F.col("_p.cy").cast("double")}).drop("_p")
    return pivoted.where(_may_hold(side, x, y))


def cell_bits(points: DataFrame, centres: DataFrame) -> tuple[int, int]:
    """Bits of the lowest cells' side, from the centres' number and extent, and levels above them until all coordinates lie
    in at most one cell on each side of 0.  No centre is an error."""
    def extent(df: DataFrame):
        return df.agg(F.count("*").alias("n"), *[f(c).cast("long").alias(f.__name__ + c) for f in (F.min, F.max) for c in ("x", "y")]).collect()[0]

    r, p = extent(centres), extent(points)
    if not r["n"]:
        raise ValueError("no centres")
    area = (r["maxx"] - r["minx"] + 1) * (r["maxy"] - r["miny"] + 1)
    bits = max(0, int(math.log2(max(1.0, math.sqrt(area * CELL_CENTRES / r["n"])))))
    far = max(abs(e[c]) for e in (r, p) for c in ("minx", "maxx", "miny", "maxy") if e[c] is not None)
    return bits, max(1, -(-(far.bit_length() - bits) // LEVEL_BITS))


def candidates(points: DataFrame, centres: DataFrame) -> tuple[DataFrame, int]:
    """``(ax, ay, i, cx, cy)``: for each cell of points the centres that may be nearest to one of them, and the cells' bits."""
    bits, levels = cell_bits(points, centres)
    centres = centres.groupBy("x", "y").agg(F.min("i").alias("i"))
    own = cut_lineage(points.select(_cell("x", bits).alias("x"), _cell("y", bits).alias("y")).distinct())
    other = cut_lineage(centres.groupBy(_cell("x", bits).alias("x"), _cell("y", bits).alias("y"))
                        .agg(F.min(F.struct(F.col("x").alias("cx"), F.col("y").alias("cy"))).alias("c")))

    def at(cells: DataFrame, level: int, x: str, y: str) -> DataFrame:
        return cells.select(_cell("x", LEVEL_BITS * level).alias(x), _cell("y", LEVEL_BITS * level).alias(y)).distinct()

    def with_centre(level: int) -> DataFrame:
        """The centres' cells with one of their centres, and the cell above them."""
        cells = other.groupBy(_cell("x", LEVEL_BITS * level).alias("_bx"), _cell("y", LEVEL_BITS * level).alias("_by")).agg(F.min("c").alias("c"))
        return cells.select(_cell("_bx", LEVEL_BITS).alias("bx"), _cell("_by", LEVEL_BITS).alias("by"), "_bx", "_by", "c.*")

    # at the top there are at most two cells on each axis
    pairs = at(own, levels, "ax", "ay").withColumn("_one", F.lit(1)).join(at(other, levels, "bx", "by").withColumn("_one", F.lit(1)), "_one").drop("_one")
    held = None
    for level in range(levels - 1, -1, -1):
        side = 1 << (bits + LEVEL_BITS * level)
        box = _stretch("bx", side), _stretch("by", side)
        mine = at(own, level, "_ax", "_ay").withColumns({"ax": _cell("_ax", LEVEL_BITS), "ay": _cell("_ay", LEVEL_BITS)})
        met = pairs.join(with_centre(level), ["bx", "by"]).select("ax", "ay", F.col("_bx").alias("bx"), F.col("_by").alias("by"), "cx", "cy")
        down = _pruned(met, side << LEVEL_BITS, *box).join(mine, ["ax", "ay"])
        down = down.select(F.col("ax").alias("_ux"), F.col("ay").alias("_uy"), F.col("_ax").alias("ax"), F.col("_ay").alias("ay"), "bx", "by", "cx", "cy", "px", "py")
        down = down.where(_may_hold(side, *box)).drop("px", "py")
        pairs = cut_lineage(_pruned(down, side, *box, "_ux", "_uy").select("ax", "ay", "bx", "by"))
        if held is not None:
            release(held)
        held = pairs
    homes = centres.select("i", F.col("x").alias("cx"), F.col("y").alias("cy"), _cell("x", bits).alias("bx"), _cell("y", bits).alias("by"))
    out = cut_lineage(_of_centres(pairs.join(homes, ["bx", "by"]), bits))
    release(own, other, *([held] if held is not None else []))
    return out, bits


def _of_centres(met: DataFrame, bits: int) -> DataFrame:
    """The pairs of cells and centres that stay."""
    at = [(F.col(c).cast("double"),) * 2 for c in ("cx", "cy")]
    return _pruned(met, 1 << bits, *at).select("ax", "ay", "i", "cx", "cy")


def _split(few: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells' lists ``(ax, ay, near)``, and the pairs of the cells with more centres than a list takes."""
    n = few.withColumn("_n", F.count("*").over(Window.partitionBy("ax", "ay")))
    lists = n.where(F.col("_n") <= LIST_MOST).groupBy("ax", "ay").agg(F.collect_list(F.struct(F.col("cx").cast("double").alias("cx"), F.col("cy").cast("double").alias("cy"), "i")).alias("near"))
    return lists, n.where(F.col("_n") > LIST_MOST).drop("_n")


def _from_list(near: str) -> Column:
    def of(c: Column) -> Column:
        return F.struct(squared_distance(F.col("x"), F.col("y"), c["cx"], c["cy"]).alias("d"), c["i"].alias("i"))
    return F.array_min(F.transform(near, of))["i"]


def _crowded(points: DataFrame, many: DataFrame, bits: int) -> DataFrame:
    """``(x, y, cluster)`` for the points of the cells of ``many``, cut into smaller cells until lists take their centres."""
    def placed(df: DataFrame, bits: int) -> DataFrame:
        return df.withColumns({"ax": _cell("x", bits), "ay": _cell("y", bits)})

    places = cut_lineage(placed(points.select("x", "y"), bits).join(many.select("ax", "ay").distinct(), ["ax", "ay"], "left_semi").select("x", "y").distinct())
    done = []
    while bits and not many.isEmpty():
        lower = max(0, bits - LEVEL_BITS)
        cells = placed(places, bits).select("ax", "ay", _cell("x", lower).alias("_ax"), _cell("y", lower).alias("_ay")).distinct()
        met = many.join(cells, ["ax", "ay"]).select(F.col("_ax").alias("ax"), F.col("_ay").alias("ay"), "i", "cx", "cy")
        bits = lower
        few = cut_lineage(_of_centres(met, bits))
        lists, many = _split(few)
        done.append(placed(places, bits).join(lists, ["ax", "ay"]).select("x", "y", _from_list("near").alias("cluster")))
    # a cell is one place: what stays there is as near as can be told
    d = squared_distance(F.col("ax"), F.col("ay"), F.col("cx"), F.col("cy"))
    last = many.groupBy("ax", "ay").agg(F.min(F.struct(d.alias("d"), "i")).alias("b"))
    done.append(last.select(F.col("ax").cast("int").alias("x"), F.col("ay").cast("int").alias("y"), F.col("b.i").alias("cluster")))
    return reduce(DataFrame.unionByName, done)


def assign_table(vectors: DataFrame, centres: DataFrame) -> DataFrame:
    """C3 for every vector, all columns kept, with ``cluster`` added (null where a coordinate is null): the index ``i`` of
    the nearest of ``centres`` (``i``, ``x``, ``y``).

    Coordinates are 32-bit integers.  Centres with a null coordinate or index are no centres.  Several
    centres at one place: the lowest index.  No centre is an error."""
    real = F.col("x").isNotNull() & F.col("y").isNotNull()
    points = vectors.select("x", "y").where(real)
    few, bits = candidates(points, centres.select("i", "x", "y").where(real & F.col("i").isNotNull()))
    lists, many = _split(few)
    lists = lists.select(F.col("ax").alias("_cell_x"), F.col("ay").alias("_cell_y"), F.col("near").alias("_near"))
    met = vectors.withColumns({"_cell_x": _cell("x", bits), "_cell_y": _cell("y", bits)}).join(lists, ["_cell_x", "_cell_y"], "left")
    out = met.select(*vectors.columns, _from_list("_near").alias("cluster"))
    if many.isEmpty():
        return out
    rest = _crowded(points, cut_lineage(many), bits).withColumnRenamed("cluster", "_of_rest")
    return out.join(rest, ["x", "y"], "left").select(*vectors.columns, F.coalesce("cluster", "_of_rest").alias("cluster"))


def nearest_of_table(points: DataFrame, centres: DataFrame) -> DataFrame:
    """``(x, y, cluster)`` for each distinct point, as in ``assign_table``.  Points with a null coordinate are left out; an
    empty table of points gives no rows."""
    places = points.select("x", "y").where(F.col("x").isNotNull() & F.col("y").isNotNull()).distinct()
    return assign_table(places, centres)
