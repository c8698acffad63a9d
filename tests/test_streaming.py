from quarry.streaming.keyword_stream import start_ranking


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    data = [(1, "Scala and Java"), (2, "Java only"), (3, "none here")]
    spark.createDataFrame(data[:2], "doc_id long, text string").write.parquet(str(src / "a"))
    spark.createDataFrame(data[2:], "doc_id long, text string").write.parquet(str(src / "b"))
    q = start_ranking(spark, str(src / "*"), ["Java", "Scala"], str(tmp_path / "ck"), str(tmp_path / "out"))
    q.awaitTermination(120)
    got = {r["kw"]: r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"Java": 2, "Scala": 1}
