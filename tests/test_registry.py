"""Every registered query vs its DuckDB oracle on the smallest driver tables,
plus the smoke entry point."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from playmart.plans import registry
from scripts.oracle_check import TABLES, rows_of

SF = os.environ.get("PLAYMART_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["period", "songid", "songname", "singer1", "RSI", "RSI_RANK", "dt_data"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql()) and set(registry.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = registry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(registry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert rows_of(sdf.columns, srows) == rows_of(ocols, orows)
