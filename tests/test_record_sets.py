"""Record sets: filter, union with clashes, ordering, clash rules."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarry.constants import SITES
from quarry.operators import record_sets as rs
from quarry.session import plan_text

SCHEMA = "user string, text string, retweets int, seq long"


def mk(spark, data):
    return spark.createDataFrame([(u, t, n, i) for i, (u, t, n) in enumerate(data)], SCHEMA)


@pytest.fixture(scope="module")
def sets(spark):
    a, b, c, d = ("a", "a body", 20), ("b", "b body", 20), ("c", "c body", 7), ("d", "d body", 9)
    return {"set5": rs.to_set(mk(spark, [a, b, c, d])), "set4c": rs.to_set(mk(spark, [a, b, c])),
            "set4d": rs.to_set(mk(spark, [a, b, d])), "empty": rs.to_set(mk(spark, []))}


def test_filter(sets):
    assert rs.filter_set(sets["empty"], F.col("user") == "a").count() == 0
    assert rs.filter_set(sets["set5"], F.col("user") == "a").count() == 1
    assert rs.filter_set(sets["set5"], F.col("retweets") == 20).count() == 2


def test_union(sets):
    assert rs.union(sets["set4c"], sets["set4d"]).count() == 4
    assert rs.union(sets["set5"], sets["empty"]).count() == 4
    assert rs.union(sets["empty"], sets["set5"]).count() == 4
    assert rows(rs.size(sets["set5"])) == [(4,)]


def test_descending_head(sets):
    first = rows(rs.descending(sets["set5"]), "user", "retweets")
    assert first[0] == ("a", 20) and [r[1] for r in first] == [20, 20, 9, 7]
    flagged = {u: h for u, _, _, h in rows(rs.head_flagged(sets["set5"]))}
    assert flagged == {"a": True, "b": False, "c": False, "d": False}
    assert rows(rs.most_retweeted(sets["set5"]), "user") == [("a",)]


def test_list_head_tail_and_emptiness(sets):
    assert rows(rs.head(sets["set5"]), "user") == [("a",)]
    assert rows(rs.tail(sets["set5"]), "user") == [("b",), ("d",), ("c",)]
    assert rows(rs.is_empty(sets["set5"])) == [(False,)] and rows(rs.is_empty(sets["empty"])) == [(True,)]
    with pytest.raises(Exception):
        rs.head(sets["empty"]).collect()


def test_members_are_small_and_never_join_on_text(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = mk(spark, [("a", "t1", 1), ("b", "t1", 2), ("c", None, 3), ("d", None, 4)])
        m = rs.members(r)
        assert m.columns == ["digest", "seq"] and sorted(rows(rs.fetch(m, r), "user")) == [("a",), ("c",)]
        for df in (rs.to_set(r), rs.fetch(rs.union_members(m, m), r), rs.remove(rs.to_set(r), r), rs.contains(m, r), rs.union(rs.to_set(r), rs.to_set(r))):
            plan = plan_text(df, "simple")
            assert "hashpartitioning(text" not in plan and "Sort [text" not in plan
        assert "Join" not in plan_text(rs.size(m), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_named_sources_in_list_order(spark):
    frames = [mk(spark, [(f"u{i}", "same text", i)]).withColumn("seq", F.col("seq") + i) for i in range(7)]
    named = rs.named_sources(SITES, frames)
    assert sorted(rows(named.select("source", rs.source_rank("source").alias("r")))) == sorted((s, i) for i, s in enumerate(SITES))
    assert rows(rs.by_site(named, SITES[3]), "user") == [("u3",)]
    assert rows(rs.union_all(named, rs.source_rank("source")), "user") == [("u6",)]
    with pytest.raises(ValueError):
        rs.named_sources(SITES, frames[:2])
    with pytest.raises(KeyError):
        rs.by_site(named, "nowhere")
    with pytest.raises(Exception):
        named.withColumn("source", F.lit("nowhere")).select(rs.source_rank("source")).collect()


def test_most_retweeted_empty_raises(sets):
    with pytest.raises(Exception):
        rs.most_retweeted(sets["empty"]).collect()
    assert rs.most_retweeted(sets["empty"], strict=False).count() == 0


def test_clash_rules(spark):
    left = rs.to_set(mk(spark, [("x", "t", 1)]))
    right = rs.to_set(spark.createDataFrame([("y", "t", 2, 5)], SCHEMA))
    assert rows(rs.union(left, right), "user") == [("y",)]            # the argument wins
    assert rows(rs.union(right, left), "user") == [("x",)]
    both = mk(spark, [("x", "t", 1), ("y", "t", 2)])
    assert rows(rs.to_set(both), "user") == [("x",)]                 # first insert wins
    src = spark.createDataFrame([("x", "t", 1, 0, 0), ("y", "t", 2, 1, 1), ("z", "t", 3, 2, 1)],
                                SCHEMA + ", src int")
    assert rows(rs.union_all(src, F.col("src")), "user") == [("y",)]   # last source, first within it


def test_contains_remove_render_topic(spark, sets):
    probe = spark.createDataFrame([("a body",), ("zzz",)], "text string")
    assert dict(rows(rs.contains(sets["set5"], probe), "text", "contained")) == {"a body": True, "zzz": False}
    assert rs.remove(sets["set5"], probe).count() == 3
    assert rows(rs.render(rs.filter_set(sets["set5"], F.col("user") == "c"))) == [("User: c\nText: c body [7]",)]
    assert sorted(r[0] for r in rows(rs.topic(sets["set5"], ["a b", "c"]), "user")) == ["a", "c"]
    assert rows(rs.trending(sets["set5"], ["a "], ["d "]), "user") == [("a",), ("d",)]


def test_trending_with_reference_topics(spark):
    data = [("gizmodo", "new Galaxy phone", 5), ("CNET", "the iPad review", 9),
            ("mashable", "nothing relevant", 50), ("engadget", "android vs iOS", 7)]
    sites = {u: i for i, u in enumerate(SITES)}
    df = spark.createDataFrame([(u, t, n, i, sites[u]) for i, (u, t, n) in enumerate(data)],
                               SCHEMA + ", src int")
    allsets = rs.union_all(df, F.col("src"))
    assert [r[0] for r in rows(rs.trending(allsets), "retweets")] == [9, 7, 5]


def test_descending_is_in_order_over_many_ranges_and_samples_no_whole_texts(spark):
    """Equal counts and equal first characters are told apart by the whole text; the ranges are made from few characters."""
    import random
    rng = random.Random(3)
    recs = [("u", "the " + "x" * rng.choice([0, 20, 60]) + str(rng.randint(0, 10**6)), rng.randint(0, 40)) for _ in range(3000)]
    recs += [("u", "le 1", None), ("u", "the 2", None), ("u", "none", 5)]
    s = spark.createDataFrame([(*r, i) for i, r in enumerate(recs)], "user string, text string, retweets int, seq long").repartition(7)
    df = rs.trending(s, ["the"], ["le"])
    want = sorted(((r[2], r[1]) for r in recs if r[1] != "none"), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r["retweets"], r["text"]) for r in df.collect()] == want
    dealt = [line for line in plan_text(df, "simple").splitlines() if "rangepartitioning" in line]
    assert dealt and all("substring(text" in line and ", text" not in line for line in dealt)
