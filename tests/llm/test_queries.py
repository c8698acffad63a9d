"""Queries that SQL can express against their SQL, and what holds for all of them."""

import duckdb
import pytest

import __spark_entry__ as E
from quarry.llm.queries import LLM_ORACLE, LLM_QUERIES
from quarry.plans.compare import rows_of
from quarry.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_all_operators_and_the_pipeline_are_registered():
    names = {k.split("_")[0] for k in E.queries() if k.startswith("op")}
    assert {f"op{n}" for n in range(1, 14)} <= names and "pipeline" in E.queries()
    assert set(LLM_ORACLE) <= set(LLM_QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(spark, con, name):
    df = LLM_QUERIES[name](spark, SF)
    rel = con.sql(LLM_ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())
