"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from quarry.plans.catalogue import QUERIES
from quarry.plans.compare import rows_of
from quarry.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) & set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["kw", "n"] and df.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(E.oracle_sql()[name])
    want = rows_of(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == want
