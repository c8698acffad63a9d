import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import qa_scores as qa
from quarry.session import plan_text

POSTING = "type int, id long, accepted long, parent_id long, score int, tags string"


def postings(spark, hot=700, lost=False):
    rng = random.Random(1)
    q = [(1, i, None, None, 0, "Java" if i % 2 else "PHP") for i in (1, 2, 3, 4)] + [(1, 3, None, None, 0, "C#"), (3, 1, None, None, 0, None)]
    a = [(2, 1000 + i, None, 1, rng.randint(-5, 50), None) for i in range(hot)]
    a += [(2, 9000, None, 2, 4, None), (2, 9001, None, 3, -4, None), (2, 9001, None, 3, 6, None), (2, 9002, None, 77, 1, None)]
    if lost:
        q += [(1, 5, None, None, 0, "Cobol"), (1, 6, None, None, 0, None), (1, 8, None, None, 0, "Cobol")]
        a += [(2, 9100 + i, None, None, 3, None) for i in range(4)] + [(2, 9200, None, 5, 2, None), (2, 9201, None, 6, 2, None)]
    return spark.createDataFrame(q + a, POSTING)


@pytest.mark.parametrize(("block", "bucket"), [(1000, 1000), (10, 25), (64, 1)])
def test_blocks_number_each_answer_once(spark, block, bucket):
    p = postings(spark)
    rows = qa.qa_groups(p, block=block, bucket_rows=bucket).collect()
    for qid, tags in {(r["qid"], r["tags"]) for r in rows}:
        own = sorted((r["block"], r["answers"]) for r in rows if (r["qid"], r["tags"]) == (qid, tags))
        numbers = [a["idx"] for _, answers in own for a in answers]
        assert numbers == list(range(len(numbers))) and all(len(x) == block for _, x in own[:-1]) and [b for b, _ in own] == list(range(len(own)))
    assert {(r["qid"], r["tags"]) for r in rows} == {(1, "Java"), (2, "PHP"), (3, "Java"), (3, "C#")}
    assert sorted(map(tuple, qa.flattened(qa.qa_groups(p, block=block, bucket_rows=bucket)).collect())) == sorted(map(tuple, qa.qa_pairs(p).collect()))


def test_the_numbers_do_not_depend_on_the_ranges(spark):
    p = postings(spark)
    one = {tuple(r) for r in qa.numbered_answers(p, bucket_rows=10_000).collect()}
    assert one == {tuple(r) for r in qa.numbered_answers(p, bucket_rows=40).collect()}
    sizes = [r["n"] for r in qa.numbered_answers(p, bucket_rows=40).withColumn("r", F.floor(F.col("idx") / 40)).groupBy("qid", "r").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) == 40


def test_groups_edge_cases(spark):
    none = spark.createDataFrame([], POSTING)
    assert qa.qa_groups(none).collect() == []
    p = postings(spark, lost=True)
    with pytest.raises(Exception, match="answer without parent"):
        qa.qa_groups(p).collect()
    assert {r["qid"] for r in qa.qa_groups(p, strict=False).collect()} == {1, 2, 3, 5, 6}
    text = plan_text(qa.qa_groups(p, strict=False), "simple")
    assert "NestedLoop" not in text and "SinglePartition" not in text


def test_dropped_rows_are_counted_by_reason(spark):
    langs = ["Java", "PHP", "C#"]
    c = qa.counted_vectors(postings(spark, lost=True), langs, 10)
    got = sorted(map(tuple, c.rows.collect()))
    assert got == sorted(map(tuple, qa.vectors(qa.scored(postings(spark, lost=True), False, langs), langs, 10, False).collect()))
    assert c.dropped() == {qa.NO_PARENT: 4, qa.NO_LANGUAGE: 2}                     # question 8 has no answer, so it is not scored
    whole = qa.counted_vectors(postings(spark), langs, 10)
    assert whole.rows.count() == 3 and whole.dropped() == {qa.NO_PARENT: 0, qa.NO_LANGUAGE: 0}
    empty = qa.counted_vectors(spark.createDataFrame([], POSTING), langs, 10)
    assert empty.rows.count() == 0 and set(empty.dropped().values()) == {0}


def test_counting_scans_the_postings_once(spark, tmp_path):
    postings(spark, lost=True).write.parquet(str(tmp_path / "p"))
    c = qa.counted_vectors(spark.read.parquet(str(tmp_path / "p")), ["Java", "PHP", "C#"], 10)
    assert plan_text(c.rows, "simple").count("FileScan parquet") == 1
