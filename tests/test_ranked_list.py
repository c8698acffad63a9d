import pytest

from quarry.operators import record_sets as rs
from quarry.operators.ranked_list import RankedList, list_page
from quarry.session import plan_text

SCHEMA = "user string, text string, retweets int, seq long"
ROWS = [(f"u{i}", f"{'same lead of more than thirty-two characters ' if i % 3 else ''}{i * 37 % 211}", i * 7 % 13 if i % 11 else None, i) for i in range(400)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture
def spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")          # the list is small
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranks_pages_and_tails(spread):
    whole = [tuple(r) for r in rs.descending(frame(spread)).collect()]
    ranked = RankedList(frame(spread))
    assert len(ranked) == 400 and len(ranked.parts) > 3
    keys = lambda rows: [(r[2], r[1]) for r in rows]
    got = sorted(ranked.ranks().collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(400)) and keys(got) == keys(whole)
    for start, count in [(0, 1), (0, 400), (17, 50), (399, 5), (400, 3), (90, 0), (350, 1000)]:
        page = ranked.page(start, count).collect()
        assert keys(page) == keys(whole[start:start + count]) and [r["rank"] for r in page] == list(range(start, min(400, start + count)))
    assert keys(ranked.nth(123).collect()) == keys([whole[123]])
    assert keys(ranked.drop(2).collect()) == keys(whole[2:]) and ranked.drop(400).count() == 0
    for bad in (-1, 400):
        with pytest.raises(IndexError):
            ranked.nth(bad)
    with pytest.raises(IndexError):
        ranked.drop(401)
    p = plan_text(ranked.page(17, 50), "simple")
    assert "SinglePartition" not in p and "Window" not in p
    ranked.release()


def test_repeats_and_empty_lists(spark):
    again = [("a", "t", 1, 1)] * 3 + [("a", None, None, 2), ("b", "", 1, 3)]
    ranked = RankedList(frame(spark, again))
    assert sorted(r["rank"] for r in ranked.ranks().collect()) == [0, 1, 2, 3, 4]
    assert ranked.nth(0).collect()[0]["text"] == "" and ranked.nth(4).collect()[0]["text"] is None
    none = RankedList(frame(spark, []))
    assert len(none) == 0 and none.page(0, 10).count() == 0 and none.drop(0).count() == 0
    with pytest.raises(IndexError):
        none.nth(0)
    assert list_page(frame(spark, []), 0, 5).count() == 0
    assert [r["rank"] for r in list_page(frame(spark), 5, 3).collect()] == [5, 6, 7]
