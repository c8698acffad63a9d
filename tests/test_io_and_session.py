"""Line sources from files (A1, A12), the JSON sink (A11), checkpoint-dir rules, input spreading."""

import json
import os
import tempfile

from conftest import rows

from quarry.session import checkpoint_dir, cut_lineage, spread
from quarry.sources import json as sj
from quarry.sources import text as st


def test_article_file_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-")
    path = os.path.join(d, "articles.dat")
    with open(path, "w") as f:
        f.write("<page> <title>Scala</title><text>Scala is great</text> </page> \n")
        f.write("<page> <title>Java</title><text>Java is OK</text> </page> \n")
    got = sorted(rows(st.parse_articles(st.read_lines(spark, path))))
    assert got == [("Java", "Java is OK"), ("Scala", "Scala is great")]


def test_word_list_file(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-")
    path = os.path.join(d, "words.txt")
    with open(path, "w") as f:
        f.write("ate\neat\ntea\n")
    assert sorted(r[0] for r in rows(st.read_lines(spark, path))) == ["ate", "eat", "tea"]


def test_json_sink(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-test-"), "out")
    df = spark.createDataFrame([("u", "a\nb", 3)], "user string, text string, retweets int")
    sj.write_json(df, out)
    back = spark.read.schema("user string, text string, retweets int").json(out)
    assert rows(back) == [("u", "a\nb", 3)]
    line = rows(sj.records_to_json(df, ["user", "text", "retweets"]))[0][0]
    assert json.loads(line) == {"user": "u", "text": "a\nb", "retweets": 3}


def test_checkpoint_dir_is_read_from_session(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert checkpoint_dir(spark) == configured
    df = cut_lineage(spark.range(10).selectExpr("id * 2 AS x"))
    assert sorted(r[0] for r in rows(df)) == [i * 2 for i in range(10)]


def test_spread_is_off_unless_a_count_is_named(spark):
    one = spark.range(0, 100, 1, 1)
    assert spread(one) is one
    assert spread(one, 4).rdd.getNumPartitions() == 4


def test_json_text_lines(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-test-"), "out")
    df = spark.createDataFrame([("ann", 'say "hi"', 51)], "user string, text string, retweets int")
    line = rows(sj.records_to_lines(df))[0][0]
    assert line == '{ "user": "ann", "text": "say \\"hi\\"", "retweets": 51.0 },'
    sj.write_lines(df, out)
    assert [r[0] for r in rows(spark.read.text(out))] == [line]
