"""The SQL oracles of the training-data queries on the smallest tables."""

import duckdb
import pytest

from playmart.llm import queries as Q
from scripts.oracle_check import rows_of

from .helpers import SF


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = Q.QUERIES[name](spark, SF)
    want = con.execute(Q.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(columns, want.fetchall())


def test_whole_tables_are_read(spark):
    """Every query returns a row (or pieces) for every document."""
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, query in Q.QUERIES.items():
        rows = query(spark, SF)
        assert rows.select("doc_id").distinct().count() == n, name
