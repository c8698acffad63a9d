"""Records as JSON lines by site: round trip, replacing sites, and reading one folder."""

import pytest
from conftest import rows

from quarry.session import plan_text
from quarry.sources import json as sj

SCHEMA = "text string, retweets int, source string"
ROWS = [("a\nb \"q\" \\ é", 1, "x"), ("", 2, "x"), (None, None, "y"), ("t", 4, None), ("t", 5, "01"), ("t", 5, "01"), ("long " * 5000, 6, "a=b/c d%")]


def ordered(df):
    return sorted(rows(df, "text", "retweets", "source"), key=str)


def test_round_trip_of_all_sites(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    sj.write_store(df, f"{tmp_path}/s")
    assert ordered(sj.read_store(spark, f"{tmp_path}/s", df.schema)) == sorted(ROWS, key=str)
    with pytest.raises(Exception, match="exists"):
        sj.write_store(df, f"{tmp_path}/s")


def test_replacing_leaves_other_sites(spark, tmp_path):
    path = f"{tmp_path}/s"
    df = spark.createDataFrame(ROWS, SCHEMA)
    sj.write_store(df, path)
    sj.write_store(spark.createDataFrame([("new", 9, "x"), ("more", 8, "z")], SCHEMA), path, replace_sites=True)
    want = [r for r in ROWS if r[2] != "x"] + [("new", 9, "x"), ("more", 8, "z")]
    assert ordered(sj.read_store(spark, path, df.schema)) == sorted(want, key=str)


def test_a_site_is_read_from_its_folder_alone(spark, tmp_path):
    path = f"{tmp_path}/s"
    df = spark.createDataFrame(ROWS, SCHEMA)
    sj.write_store(df, path)
    (tmp_path / "s" / "source=y").joinpath("broken.json").write_text("{no json")
    one = sj.stored_site(spark, path, df.schema, "01", ["01", "x", "none"])
    assert ordered(one) == [("t", 5, "01")] * 2                          # the broken folder is not looked at
    assert "PartitionFilters: [isnotnull(source" in plan_text(one) and "= 01)]" in plan_text(one)
    assert sj.stored_site(spark, path, df.schema, "none", ["01", "none"]).count() == 0
    with pytest.raises(KeyError):
        sj.stored_site(spark, path, df.schema, "y", ["x"])
    with pytest.raises(Exception, match="(?i)malformed"):
        sj.read_store(spark, path, df.schema).collect()


def test_empty_names_raise_and_empty_tables_write(spark, tmp_path):
    with pytest.raises(Exception, match="without a name"):
        sj.write_store(spark.createDataFrame([("t", 1, "")], SCHEMA), f"{tmp_path}/e")
    none = spark.createDataFrame([], SCHEMA)
    sj.write_store(none, f"{tmp_path}/n")
    assert sj.read_store(spark, f"{tmp_path}/n", none.schema).count() == 0
