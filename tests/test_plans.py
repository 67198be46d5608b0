"""Plan shape: pruning and pushdown reach the scan, semi joins stay semi joins,
no Python evaluation anywhere in a registered query."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from playmart.plans import registry
from playmart.plans import schemas as S
from playmart.sources.tables import read_day_table, write_days

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_filter_is_partition_filter(spark, tmpdir_path):
    rows = spark.createDataFrame([(str(i), f"2024010{i % 3 + 1}") for i in range(30)], "songid string, dt_data string")
    for c in S.PLAY_LOG.fieldNames():
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    write_days(rows.select(*S.PLAY_LOG.fieldNames()), tmpdir_path)
    df = read_day_table(spark, tmpdir_path, S.PLAY_LOG, day="20240102")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(dt_data" in p and "20240102" in p
    assert df.count() == 10
    assert dict(zip(df.columns, [f.dataType.simpleString() for f in df.schema]))["dt_data"] == "string"


def test_semi_join_for_refunds(spark):
    df = E.queries()["machine_refund"](spark, SF)
    assert "LeftSemi" in plan(df)


def test_scan_prunes_columns(spark):
    p = plan(E.queries()["features_onepass"](spark, SF))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    # events.value is not needed and must not be read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in scan
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in scan


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_udf(spark, name):
    if name.endswith("roundtrip"):
        pytest.skip("writes files")
    p = plan(E.queries()[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_onepass_features_partial_aggregation(spark):
    p = plan(E.queries()["features_onepass"](spark, SF))
    assert "Expand" not in p and "SortAggregate" not in p
    assert p.count("partial_count") >= 1


def test_ranks_read_the_source_once(spark):
    """What ranks reads the sorted runs and the extents: no scan of the source, no window over the rows."""
    for name in ("rank_lines", "rank_lines_desc"):
        p = plan(E.queries()[name](spark, SF))
        assert "lineitem.parquet" not in p and "playmart-rank" in p
        assert "BroadcastHashJoin" in p and p.count("Exchange hashpartitioning") <= 1


@pytest.mark.parametrize("name", ["machine_revenue_grain", "machine_revenue_mid", "province_revenue"])
def test_only_refunds_and_paid_ids_meet_by_order_id(spark, name):
    """No exchange by order id carries the group columns of payments; the rows of the fact go through partial sums."""
    p = plan(E.queries()[name](spark, SF))
    assert "LeftSemi" in p and "partial_sum" in p
    assert "Window" not in p.split("LeftSemi")[1]
