import json
import os
import tempfile

import pytest
from conftest import rows

from quarry.sources import json as sj
from quarry.sources import text as st


def test_parse_articles(spark):
    line = "<page> <title>Hello</title><text>Body text</text> </page> "
    df = spark.createDataFrame([(line,)], "value string")
    assert rows(st.parse_articles(df)) == [("Hello", "Body text")]


def test_parse_articles_missing_separator_raises(spark):
    df = spark.createDataFrame([("no separator here at all",)], "value string")
    with pytest.raises(Exception):
        st.parse_articles(df).collect()


def test_parse_postings(spark):
    lines = ["1,100,,,5,Java", "1,101,,,0,", "1,102,105,,7,Scala", "2,103,,100,-4,",
             "2,104,,100,-1", "2,105,,102,9,", "2,106,,999,3,", "3,107,,,1,"]
    df = st.parse_postings(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = {r[1]: r for r in rows(df)}
    assert got[100] == (1, 100, None, None, 5, "Java")
    assert got[101][5] is None
    assert got[102][2] == 105
    assert got[104] == (2, 104, None, 100, -1, None)
    assert df.schema["score"].dataType.simpleString() == "int"


def test_parse_postings_bad_integer_raises(spark):
    df = spark.createDataFrame([("1,abc,,,5,Java",)], "value string")
    with pytest.raises(Exception):
        st.parse_postings(df).collect()


def test_wide_csv_header_schema(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-")
    path = os.path.join(d, "survey.csv")
    with open(path, "w") as f:
        f.write("tucaseid,t010101,t030101,t050101,t020101\n")
        f.write("a,60,30,90,0\nb,0,0,0,120\n")
    cols, df = st.read_wide_csv(spark, path)
    assert cols == ["tucaseid", "t010101", "t030101", "t050101", "t020101"]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string"] + ["double"] * 4
    assert rows(df)[0] == ("a", 60.0, 30.0, 90.0, 0.0)


def test_json_records_roundtrip(spark):
    data = [{"user": "ignored", "text": "a \"quoted\"\nline", "retweets": 51.0},
            {"text": "y", "retweets": 7.9}]
    df = spark.createDataFrame([("src", json.dumps(data)), ("none", "[]")], "source string, json string")
    out = rows(sj.json_records(df, "json", "source"))
    assert out == [("src", "a \"quoted\"\nline", 51), ("src", "y", 7)]
    back = rows(sj.records_to_json(spark.createDataFrame(
        [("u", 't"1', 3)], "user string, text string, retweets int"), ["user", "text", "retweets"]))
    assert json.loads(back[0][0]) == {"user": "u", "text": 't"1', "retweets": 3}


def test_json_map(spark):
    df = spark.createDataFrame([('{"k": 69}',)], "props string")
    assert rows(df.select(sj.json_map("props")["k"].alias("k"))) == [("69",)]


def test_parse_postings_strict_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("1,x1,,,5,Java",)], "value string")
        with pytest.raises(Exception):
            st.parse_postings(df).collect()
        ok = spark.createDataFrame([("2,7,,3,-1",)], "value string")
        assert rows(st.parse_postings(ok)) == [(2, 7, None, 3, -1, None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ['[{"text": "a", "retweets": 1', '[{"retweets": 1}]', '[{"text": "a"}]', '[{"text": null, "retweets": 2}]', "nonsense", None])
def test_broken_json_and_missing_fields_raise(spark, ansi, text):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("u", text)], "source string, json string")
        with pytest.raises(Exception):
            sj.json_records(df, "json", "source").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_broken_json_object_raises_and_null_stays(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("{broken",)], "props string").select(sj.json_map("props")).collect()
    assert rows(spark.createDataFrame([(None,)], "props string").select(sj.json_map("props").alias("m"))) == [(None,)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("line", ["1, 7,,,5,Java", "1,7 ,,,5,Java", "4294967297,7,,,5,Java", "1,7,,,99999999999,Java", "1,99999999999999999999,,,5,Java",
                                  "1,7,x,,5,Java", "1,7,, 8,5,Java", ",7,,,5,Java", "1,7"])
def test_bad_integers_raise(spark, ansi, line):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception):
            st.parse_postings(spark.createDataFrame([(line,)], "value string")).collect()
        assert rows(st.parse_postings(spark.createDataFrame([("+1,-7,,,5,Java",)], "value string")), "type", "id") == [(1, -7)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_wide_csv_empty_numbers_and_swapped_headers_raise(spark, ansi, tmp_path):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        (tmp_path / "a").mkdir()
        (tmp_path / "a" / "x.csv").write_text("id,t1,t2\nr1,1,2\n,3,4\n")
        assert sorted(rows(st.read_wide_csv(spark, str(tmp_path / "a"))[1])) == [("", 3.0, 4.0), ("r1", 1.0, 2.0)]
        (tmp_path / "a" / "y.csv").write_text("id,t2,t1\nr2,1,2\n")
        with pytest.raises(Exception):
            st.read_wide_csv(spark, str(tmp_path / "a"))[1].collect()
        (tmp_path / "b.csv").write_text("id,t1,t2\nr1,,2\n")
        with pytest.raises(Exception, match="empty number"):
            st.read_wide_csv(spark, str(tmp_path / "b.csv"))[1].collect()
        (tmp_path / "c.csv").write_text("id,t1\nr1,x\n")
        with pytest.raises(Exception):
            st.read_wide_csv(spark, str(tmp_path / "c.csv"))[1].collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_lines_and_survey_files_come_back_row_by_row(spark, tmp_path):
    lines = ["1,100,,,5,Java", "", " padded ", "tab\there", "é"] * 3
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(4)
    st.write_lines(df, str(tmp_path / "lines"))
    assert len(list((tmp_path / "lines").glob("part-*"))) > 1
    assert sorted(rows(st.read_lines(spark, str(tmp_path / "lines")))) == sorted((x,) for x in lines)
    wide = [(f"id {i}", i * 0.1, -1e300 / 3, float(i)) for i in range(50)] + [("", 1.0, 2.0, 3.0), ('q"uote', 0.0, 1.5, 2.0), (" padded ", 5e-324, 1.0, 1.0)]
    df = spark.createDataFrame(wide, "id string, a double, b double, c double").repartition(3)
    st.write_wide_csv(df, str(tmp_path / "wide"))
    columns, back = st.read_wide_csv(spark, str(tmp_path / "wide"))
    assert columns == ["id", "a", "b", "c"] and sorted(rows(back)) == sorted(wide)


def test_files_that_could_not_be_read_back_raise(spark, tmp_path):
    for i, bad in enumerate([None, "two\nlines", "two\rlines"]):
        with pytest.raises(Exception, match="line break"):
            st.write_lines(spark.createDataFrame([("fine",), (bad,)], "value string"), str(tmp_path / f"l{i}"))
    for i, bad in enumerate([("a,b", 1.0), (None, 1.0), ("a", None), ("a\nb", 1.0)]):
        with pytest.raises(Exception, match="cannot be written"):
            st.write_wide_csv(spark.createDataFrame([bad], "id string, x double"), str(tmp_path / f"w{i}"))
    ok = spark.createDataFrame([("a", 1.0)], "id string, x double")
    st.write_wide_csv(ok, str(tmp_path / "mixed"))
    st.write_wide_csv(ok.withColumnRenamed("x", "y"), str(tmp_path / "other"))
    for f in (tmp_path / "other").glob("part-*"):
        (tmp_path / "mixed" / f"part-9{f.name[5:]}").write_bytes(f.read_bytes())
    with pytest.raises(Exception, match="(?i)header"):
        st.read_wide_csv(spark, str(tmp_path / "mixed"))[1].collect()
