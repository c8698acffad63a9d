"""Postings, scoring, sampling and k-means rules plus a plain-Python model."""

import random

import pytest
from conftest import rows

from quarry.operators import cluster_report as cr
from quarry.operators import kmeans as km
from quarry.operators import qa_scores as qa
from quarry.operators import sampling as smp
from quarry.sources import text as st

from quarry.constants import LANGUAGES as LANGS15
LINES = ["1,100,,,5,Java", "1,101,,,0,", "1,102,105,,7,Scala", "2,103,,100,-4,",
         "2,104,,100,-1", "2,105,,102,9,", "2,106,,999,3,", "3,107,,,1,"]


@pytest.fixture(scope="module")
def postings(spark):
    return st.parse_postings(spark.createDataFrame([(x,) for x in LINES], "value string"))


def test_pairs_and_scores(postings):
    assert sorted(rows(qa.qa_pairs(postings), "qid", "score")) == [(100, -4), (100, -1), (102, 9)]
    assert sorted(rows(qa.scored(postings), "qid", "high_score")) == [(100, 0), (102, 9)]


def test_vectors(postings):
    v = rows(qa.vectors(qa.scored(postings), LANGS15, 50000), "qid", "x", "y")
    assert sorted(v) == [(100, 50000, 0), (102, 500000, 9)]


def test_unknown_tag_raises(spark):
    df = spark.createDataFrame([(1, "Cobol", 3)], "qid long, tags string, high_score int")
    with pytest.raises(Exception):
        qa.vectors(df, LANGS15, 50000).collect()
    assert qa.vectors(df, LANGS15, 50000, strict=False).count() == 0


def test_orphan_answer_without_parent_raises(spark):
    df = st.parse_postings(spark.createDataFrame([("1,1,,,0,Java",), ("2,2,,,3,",)], "value string"))
    with pytest.raises(Exception):
        qa.qa_pairs(df).collect()


def pts(spark, data):
    return spark.createDataFrame(data, "x int, y int").groupBy("x", "y").count().withColumnRenamed("count", "w")


def test_mean_truncates(spark):
    assert km.step(pts(spark, [(1, 1), (2, 2)]), [(0, 0)]) == [(1, 1)]
    assert km.step(pts(spark, [(-1, -1), (-2, -2)]), [(0, 0)]) == [(-1, -1)]


def test_tie_goes_to_lower_index(spark):
    df = spark.createDataFrame([(5, 0)], "x int, y int")
    assert rows(km.assign(df, [(0, 0), (10, 0)]), "cluster") == [(0,)]


def test_empty_cluster_keeps_mean(spark):
    assert km.step(pts(spark, [(0, 0), (1, 1)]), [(0, 0), (1000, 1000)]) == [(0, 0), (1000, 1000)]


def test_squared_distance():
    assert km.shift([(0, 0)], [(3, 4)]) == 25.0


def test_median_rules(spark):
    df = spark.createDataFrame([(0, y, 1) for y in (1, 4, 6, 7)], "x int, y int, w long")
    assert rows(cr.report(df, [(0, 0)], ["L"], 50000), "median", "size") == [(5, 4)]
    df2 = spark.createDataFrame([(0, 1, 1), (0, 4, 1)], "x int, y int, w long")
    assert rows(cr.report(df2, [(0, 0)], ["L"], 50000), "median") == [(2,)]


def _py_kmeans(points, means, eta, max_iter):
    def close(p):
        best, bd = 0, float("inf")
        for i, (mx, my) in enumerate(means_):
            d = float(p[0] - mx) ** 2 + float(p[1] - my) ** 2
            if d < bd:
                best, bd = i, d
        return best
    means_ = list(means)
    it = 1
    while True:
        groups = {}
        for p in points:
            groups.setdefault(close(p), []).append(p)
        new = list(means_)
        for i, g in groups.items():
            sx, sy = sum(p[0] for p in g), sum(p[1] for p in g)
            new[i] = (int(sx / len(g)), int(sy / len(g)))  # truncation toward zero
        d = sum(float(a - c) ** 2 + float(b - e) ** 2 for (a, b), (c, e) in zip(means_, new))
        if d < eta or it >= max_iter:
            return new, it
        means_, it = new, it + 1


def test_fit_matches_plain_python_model(spark):
    rnd = random.Random(7)
    points = [(rnd.randrange(3) * 50000, rnd.randrange(-20, 200)) for _ in range(600)]
    means = [(0, 5), (0, 50), (50000, 5), (50000, 80), (100000, 100), (100000, 10)]
    vec = spark.createDataFrame(points, "x int, y int")
    res = km.fit(km.weighted_points(vec), means, 20.0, 120)
    expect, iters = _py_kmeans(points, means, 20.0, 120)
    assert res.means == expect and res.iterations == iters
    report = rows(cr.report(km.weighted_points(vec), res.means, ["A", "B", "C"], 50000), "size")
    assert sum(r[0] for r in report) == len(points)   # cluster sizes add up


def test_sampling_per_group_and_global(spark):
    df = spark.createDataFrame([(i, (i % 3) * 50000, i) for i in range(60)], "qid long, x int, y int")
    s = rows(smp.sample_per_group(df, "x", 4, 42, "qid"), "x")
    assert sorted(s) == sorted([(0,)] * 4 + [(50000,)] * 4 + [(100000,)] * 4)
    again = rows(smp.sample_per_group(df, "x", 4, 42, "qid"), "qid")
    assert sorted(again) == sorted(rows(smp.sample_per_group(df, "x", 4, 42, "qid"), "qid"))
    assert smp.sample_global(df, 5, 42, "qid").count() == 5
    init = rows(smp.initial_means(df, 6, 3, seed=42), "i")
    assert sorted(init) == [(i,) for i in range(6)]
    with pytest.raises(Exception):
        smp.sample_per_group(df, "x", 25, 42, "qid").collect()
    with pytest.raises(ValueError):
        smp.initial_means(df, 7, 3, seed=42)


def test_report_text_format(spark):
    df = spark.createDataFrame([(0, 3, 1)], "x int, y int, w long")
    lines = rows(cr.report_text(cr.report(df, [(0, 0)], ["Java"], 50000)), "line_no", "line")
    assert [n for n, _ in lines] == [0, 1, 2, 3]
    assert lines[0][1] == "Resulting clusters:" and lines[2][1] == "=" * 48
    assert lines[3][1] == "      3  Java              (100.0%)            1"


def test_fused_vectors_equal_joined_form(postings, spark):
    fused = sorted(rows(qa.vectors_from_postings(postings, LANGS15, 50000), "qid", "x", "y"))
    joined = sorted(rows(qa.vectors(qa.scored(postings), LANGS15, 50000), "qid", "x", "y"))
    assert fused == joined == [(100, 50000, 0), (102, 500000, 9)]
    bad = st.parse_postings(spark.createDataFrame([("1,1,,,0,Cobol",), ("2,2,,1,3,",)], "value string"))
    with pytest.raises(Exception):
        qa.vectors_from_postings(bad, LANGS15, 50000).collect()
    assert qa.vectors_from_postings(bad, LANGS15, 50000, strict=False).count() == 0


def _postings(spark, lines):
    return st.parse_postings(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_null_tags_raise_in_both_forms(spark):
    p = _postings(spark, ["1,1,,,0,", "2,2,,1,3,"])
    for df in (qa.vectors_from_postings(p, LANGS15, 50000), qa.vectors(qa.scored(p), LANGS15, 50000)):
        with pytest.raises(Exception, match="tag"):
            df.collect()
    assert qa.vectors_from_postings(p, LANGS15, 50000, strict=False).count() == 0
    assert qa.vectors(qa.scored(p), LANGS15, 50000, strict=False).count() == 0
    unanswered = _postings(spark, ["1,1,,,0,", "1,2,,,0,Java", "2,3,,2,3,"])
    assert rows(qa.vectors_from_postings(unanswered, LANGS15, 50000), "qid") == [(2,)]


def test_repeated_question_ids_are_one_row(spark):
    p = _postings(spark, ["1,1,,,0,Scala", "1,1,,,0,Java", "1,1,,,0,Cobol", "1,1,,,0,", "2,2,,1,3,", "2,3,,1,8,"])
    assert rows(qa.scored(p), "qid", "tags", "high_score") == [(1, "Java", 8)]
    want = [(1, 50000, 8)]
    assert rows(qa.vectors_from_postings(p, LANGS15, 50000), "qid", "x", "y") == want
    assert rows(qa.vectors(qa.scored(p), LANGS15, 50000), "qid", "x", "y") == want


def test_too_few_initial_means_raise(spark):
    df = spark.createDataFrame([(i, (i % 2) * 50000, i) for i in range(60)], "qid long, x int, y int")   # one language is absent
    with pytest.raises(Exception, match="fewer than"):
        smp.initial_means(df, 45, 3).collect()
    with pytest.raises(Exception, match="fewer than"):
        smp.initial_means(df.limit(5), 6, 3, method="global").collect()
    assert smp.initial_means(df, 6, 3, method="global").count() == 6
    with pytest.raises(ValueError):
        smp.initial_means(df, 6, 3, method="other")


def test_more_than_a_thousand_rows_a_group(spark):
    df = spark.range(5000).selectExpr("id AS qid", "cast(id % 2 as int) AS x", "cast(id as int) AS y")
    picked = rows(smp.sample_per_group(df, "x", 1001, 42, "qid"), "qid", "x")
    import hashlib
    want = []
    for g in (0, 1):
        ids = sorted(range(g, 5000, 2), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
        want += [(i, g) for i in ids[:1001]]
    assert sorted(picked) == sorted(want)


def test_fit_says_how_it_ended(spark):
    vec = spark.createDataFrame([(0, y) for y in range(0, 400, 3)], "x int, y int")
    points = km.weighted_points(vec)
    short = km.fit(points, [(0, 0), (0, 1)], 20.0, 1)
    assert (short.converged, short.iterations) == (False, 1)
    with pytest.raises(RuntimeError):
        km.fit(points, [(0, 0), (0, 1)], 20.0, 1, strict=True)
    full = km.fit(points, [(0, 0), (0, 1)], 20.0, 120)
    assert full.converged
    assert rows(km.with_state(km.means_frame(spark, full.means), full), "converged", "iterations")[0] == (True, full.iterations)
    points.unpersist()
