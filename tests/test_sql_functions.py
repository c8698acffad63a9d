"""The row rules as SQL functions against the column builders, and key sets with SQL text."""

from conftest import rows
from pyspark.sql import functions as F

from quarry.functions import sql
from quarry.functions import text as T
from quarry.operators import key_sets as ks
from quarry.operators import kmeans as km
from quarry.session import plan_text

TEXTS = ["a (b) the", "", None, ")(", "((x)", "Hello the  ", " the", "the,", "Äpfel und Öl", "aab bbc", "x" * 5000 + "()"]


def test_functions_equal_the_column_builders(spark):
    d = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = sql.query(spark, """SELECT t, space_tokens(t), mentions(t, 'the'), contains_any(t, array('the', 'x')), characters(t), signature(t),
        occurrences(signature(t)), subtract_signature(signature(t), 'ab'), balanced(t), letter_count(t, 'b') FROM {d}""", d=d)
    want = d.select("t", T.space_tokens("t"), T.mentions("t", "the"), T.contains_any("t", ["the", "x"]), T.characters("t"), T.signature("t"),
                    T.occurrences(T.signature("t")), T.subtract_signature(T.signature("t"), F.lit("ab")), T.balanced("t"), T.letter_count(F.col("t"), F.lit("b")))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_distance_does_not_overflow(spark):
    d = spark.createDataFrame([(2 ** 31 - 1, -2 ** 31, 0, 5)], "a int, b int, c int, d int")
    got = sql.query(spark, "SELECT squared_distance(a, c, b, d) AS d FROM {d}", d=d)
    assert rows(got) == rows(d.select(km.squared_distance(F.col("a"), F.col("c"), F.col("b"), F.col("d")).alias("d")))


def test_plans_hold_no_call(spark):
    """The bodies are inlined: no Python worker, and a filter through a function reaches the scan's columns only."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = plan_text(sql.query(spark, "SELECT doc_id FROM {docs} WHERE mentions(text, 'the') AND doc_id > 5", docs=docs))
    assert "Python" not in plan and "GreaterThan(doc_id,5)" in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_registering_twice_and_functions_of_functions(spark):
    assert sql.register(spark) == sql.register(spark)
    assert spark.sql("SELECT occurrences(signature('Lives')) AS o").first()["o"] == "e1i1l1s1v1"


def test_key_sets_take_sql_text(spark):
    s = spark.createDataFrame([(x,) for x in (1, 3, 4, 5, 7, 1000)], "k long")
    assert sorted(rows(ks.filter_keys(s, "k % 2 = 1"))) == sorted(rows(ks.filter_keys(s, lambda k: k % 2 == 1)))
    assert sorted(rows(ks.map_keys(s, "k DIV 4"))) == [(0,), (1,), (250,)]
    assert rows(ks.forall(s, "k < 1000")) == [(False,)] and rows(ks.forall(s, "k < 1000", bound=999)) == [(True,)]
    assert rows(ks.exists(s, "k = 7")) == [(True,)] and rows(ks.exists(s.filter("k < 0"), "true")) == [(False,)]
