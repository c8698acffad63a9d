"""The pipeline's stages, each against brute force on its own input, and the whole."""

import hashlib

import corpus_pipeline
from quarry.llm.common import written
from test_decontaminate import brute as leaks
from test_set_join import brute as groups
from test_substring_dedup import brute as repeats
from test_token_files import check_pieces

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "set_join", "substring_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "", "en", "s", 0), (-3, "12 34 !", "en", "s", 7)], docs.schema)
    docs = written(docs.unionByName(odd), "docs")

    known = written(stages["language_id"](spark, docs, SF), "a")
    assert known.columns == docs.columns
    gone = {d for d, _ in rows(docs)} - {d for d, _ in rows(known)}
    assert {-1, -2, -3} <= gone and all(not any(c.isalpha() for c in t or "") for d, t in rows(docs) if d in gone)

    single = written(stages["set_join"](spark, known, SF), "b")
    assert single.columns == docs.columns
    want = sorted(d for d, _, c in groups(rows(known), k=5, percent=80) if d == c)
    assert sorted(d for d, _ in rows(single)) == want and len(want) < known.count()
    assert set(rows(single)) <= set(rows(known))

    bare = written(stages["substring_dedup"](spark, single, SF), "c")
    judged = {d: (n, h) for d, _, n, h in repeats(rows(single), 35)}
    before = dict(rows(single))
    for d, t in rows(bare):
        n, digest = judged[d]
        assert t == before[d] if not n else hashlib.sha256(t.encode()).hexdigest() == digest
    assert bare.columns == docs.columns and bare.count() == single.count()
    assert bare.where("n_chars != length(text)").count() == 0

    clean = written(stages["decontamination"](spark, bare, SF), "d")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    short = [x for x in rows(bare) if len(x[1] or "") < 4000]
    hit = {d for d, _ in leaks(short, items)}
    kept = {d for d, _ in rows(clean)}
    assert kept & {d for d, _ in short} == {d for d, _ in short} - hit
    assert set(rows(clean)) <= set(rows(bare)) and clean.columns == docs.columns

    check_pieces(stages["packing"](spark, clean, SF).collect(), rows(clean))


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 100
    assert corpus_pipeline.ORACLE_SQL is None


def test_one_of_each_keeps_one_of_repeated_rows(spark):
    from quarry.llm.set_join import keep_one_of_each
    rows_ = [(3, "a b c d e f", "x"), (3, "a b c d e f", "y"), (4, "a b c d e f", "z"), (5, None, ""), (5, None, ""), (None, "a b c d e f", ""), (6, "other words", "")]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, `_key` string")
    docs = docs.withColumnRenamed("_key", "key")
    got = sorted((r["doc_id"] for r in keep_one_of_each(docs).collect()), key=str)
    assert got == [3, 5, 5, 6] and keep_one_of_each(docs).columns == docs.columns
    assert keep_one_of_each(docs.where("doc_id < 0")).count() == 0
