import random

import pytest

from quarry.operators import kmeans as km
from quarry.operators import nearest_centres as nc
from quarry.session import plan_text


def brute(points, centres):
    return {(x, y): min((float(x - cx) ** 2 + float(y - cy) ** 2, i) for i, cx, cy in centres)[1] for x, y in points}


def run(spark, points, centres):
    p = spark.createDataFrame(points, "x int, y int")
    c = spark.createDataFrame(centres, "i int, x int, y int")
    return {(r["x"], r["y"]): r["cluster"] for r in nc.nearest_of_table(p, c).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_random_points_with_ties_and_far_ones(spark, seed):
    rng = random.Random(seed)
    span = (30, 1000, 2_000_000_000)[seed]
    centres = [(i, rng.randint(-span, span) // 2, rng.randint(-span, span) // (2 if seed else 30)) for i in range(300)]
    centres += [(1000 + i, x, y) for i, (_, x, y) in enumerate(centres[:50])]           # several centres at one place
    rng.shuffle(centres)
    points = [(rng.randint(-span, span), rng.randint(-span, span)) for _ in range(400)] + [(x, y) for _, x, y in centres[:40]] + [(-span, span), (span, -span)] * 3
    assert run(spark, points, centres) == brute(points, centres)


def test_same_as_the_literal_form_for_5000_centres(spark):
    rng = random.Random(9)
    means = [(rng.randint(0, 3000), rng.randint(-400, 400)) for _ in range(5000)]
    p = spark.createDataFrame([(i, rng.randint(-200, 3500), rng.randint(-900, 900)) for i in range(1500)], "qid int, x int, y int")
    want = {r["qid"]: r["cluster"] for r in km.assign(p, means).collect()}
    got = {r["qid"]: r["cluster"] for r in nc.assign_table(p, km.means_frame(spark, means)).collect()}
    assert got == want


def test_few_candidates_and_no_product(spark):
    """Far-off points, each in a cell of its own, against a dense block of centres meet a few of them only."""
    points = spark.createDataFrame([(10_000_000 + 997 * i, 31 * i) for i in range(500)], "x int, y int")
    centres = spark.createDataFrame([(i, i % 40, i // 40) for i in range(1600)], "i int, x int, y int")
    few, _ = nc.candidates(points, centres)
    assert few.count() < 500 * 200
    p = plan_text(nc.nearest_of_table(points, centres), "simple")
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_edge_cases(spark):
    centres = [(7, 5, 5), (3, 5, 5), (9, -5, 5)]
    assert run(spark, [(0, 5), (None, 5), (5, 5), (5, 5)], [*centres, (1, None, 5), (None, 0, 5)]) == {(0, 5): 3, (5, 5): 3}
    assert run(spark, [], centres) == {}
    with pytest.raises(ValueError, match="no centres"):
        run(spark, [(1, 1)], [])
    v = spark.createDataFrame([(1, 0, 5, "a"), (2, None, 5, "b"), (3, 0, 5, "c")], "id int, x int, y int, ax string")
    got = nc.assign_table(v, spark.createDataFrame(centres, "i int, x int, y int"))
    assert got.columns == ["id", "x", "y", "ax", "cluster"]
    assert sorted((r["id"], r["ax"], r["cluster"]) for r in got.collect()) == [(1, "a", 3), (2, "b", None), (3, "c", 3)]


def test_far_cells_keep_no_more_pairs_than_near_ones(spark):
    """A strip of centres: the farther a cell, the wider the ring that holds its nearest, but few of it can be nearest."""
    rng = random.Random(4)
    centres = spark.createDataFrame([(i, rng.randint(0, 100_000), i) for i in range(3000)], "i int, x int, y int")
    points = spark.createDataFrame([(rng.randint(0, 100_000), 400_000 + rng.randint(0, 100_000)) for _ in range(600)], "x int, y int")
    few, _ = nc.candidates(points, centres)
    assert few.count() < 8 * few.select("ax", "ay").distinct().count()


def test_points_are_not_expanded_or_grouped(spark):
    """A point meets its cell's list: one join of the vectors, no aggregate by a point."""
    rng = random.Random(5)
    centres = spark.createDataFrame([(i, rng.randint(0, 3000), rng.randint(0, 3000)) for i in range(500)], "i int, x int, y int")
    v = spark.createDataFrame([(i, rng.randint(0, 3000), rng.randint(0, 3000)) for i in range(900)], "id int, x int, y int")
    p = plan_text(nc.assign_table(v, centres), "simple")
    assert "SortAggregate" not in p and "keys=[x" not in p


def test_crowded_cells_are_cut_further(spark, monkeypatch):
    """One far centre makes the cells so large that all others are in one; and many centres at one distance from a point."""
    monkeypatch.setattr(nc, "LIST_MOST", 5)
    rng = random.Random(6)
    centres = [(i, rng.randint(0, 60), rng.randint(0, 60)) for i in range(400)] + [(1000, 500_000, -500_000)]
    ring = [(2000 + i, 100_000 + a, b) for i, (a, b) in enumerate((s * a, t * b) for a, b in ((25, 60), (60, 25), (39, 52), (52, 39), (16, 63), (63, 16)) for s in (1, -1) for t in (1, -1))]
    points = [(rng.randint(-20, 80), rng.randint(-20, 80)) for _ in range(200)] + [(100_000, 0), (100_001, 0), (499_999, -500_003)]
    v = spark.createDataFrame([(i, *p) for i, p in enumerate([*points, *points, (None, 3)])], "id int, x int, y int")
    got = [(r["x"], r["y"], r["cluster"]) for r in nc.assign_table(v, spark.createDataFrame(centres + ring, "i int, x int, y int")).collect()]
    want = brute(points, centres + ring)
    assert len(got) == 2 * len(points) + 1 and all(c == want.get((x, y)) for x, y, c in got)
