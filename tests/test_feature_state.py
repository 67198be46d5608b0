"""The maintained state against the scan of the whole window."""

import random

import pytest
from pyspark.sql import functions as F

from playmart.functions.dates import shift_day
from playmart.operators import features as feat
from playmart.operators.feature_state import FeatureState, advance, day_state, features_of_state
from playmart.sources.tables import write_days

DDL = "songid string, uid string, order_id string, dt_data string"
LAST = "20240320"


def some_plays(n=1500, span=45, seed=2):
    rnd = random.Random(seed)
    pick = lambda k, none: None if rnd.random() < none else str(rnd.randrange(k))
    return [(pick(12, 0.05), pick(30, 0.1), pick(200, 0.3), shift_day(LAST, rnd.randrange(span))) for _ in range(n)]


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def test_thirty_days_one_by_one_with_a_late_and_a_changed_day(spark, tmpdir_path):
    rows = some_plays()
    plays = spark.createDataFrame(rows, DDL).cache()
    late, changed = shift_day(LAST, 20), shift_day(LAST, 12)
    state = FeatureState(spark, f"{tmpdir_path}/state")
    wrong = spark.createDataFrame([("1", "999", "x9", changed), ("77", "1", None, changed)], DDL)
    known = plays.where(~F.col("dt_data").isin(late, changed)).unionByName(wrong)
    for back in range(30, -1, -1):
        day = shift_day(LAST, back)
        if back == 8:  # both become right after they were passed
            state.advance(plays, day, changed=[late, changed])
        else:
            state.advance(known if back > 8 else plays, day)
        if back in (15, 8, 3, 0):
            scan = feat.rolling_features(known if back > 8 else plays, day)
            got = features_of_state(state.of(day))
            assert sorted(got.columns) == sorted(scan.columns)
            assert rows_of(got) == rows_of(scan), back
    assert rows_of(state.advance(plays, LAST)) == rows_of(state.of(LAST))  # a re-run reads the state before it


def test_gaps_are_read_and_old_states_restart(spark, tmpdir_path):
    plays = spark.createDataFrame(some_plays(600, 80, 5), DDL)
    state = FeatureState(spark, f"{tmpdir_path}/state", widest=30)
    for back in (60, 58, 40, 2, 0):  # 40 -> 2 is longer than the window
        day = shift_day(LAST, back)
        state.advance(plays, day)
        assert rows_of(features_of_state(state.of(day))) == rows_of(feat.rolling_features(plays, day)), back
    assert state.latest() == LAST and state.latest(LAST) == shift_day(LAST, 2)


def test_advance_reads_the_new_day_only(spark, tmpdir_path):
    write_days(spark.createDataFrame(some_plays(), DDL), f"{tmpdir_path}/plays")
    plays = spark.read.schema(DDL).parquet(f"{tmpdir_path}/plays")
    state = FeatureState(spark, f"{tmpdir_path}/state")
    state.advance(plays, shift_day(LAST, 1))
    rows = day_state(plays, LAST, [LAST])
    new = advance(state.of(state.latest()), state.latest(), rows, LAST, [LAST])
    p = new._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2 and sum(f"dt_data" in s and LAST in s for s in scans) == 1 and sum("as_of" in s for s in scans) == 1
    assert p.count("Exchange hashpartitioning") == 2  # the day's rows, and the merge


def test_wrong_calls_and_empty_tables(spark, tmpdir_path):
    empty = spark.createDataFrame([], DDL)
    state = FeatureState(spark, f"{tmpdir_path}/state")
    assert state.latest() is None
    assert features_of_state(state.advance(empty, LAST)).count() == 0
    one = day_state(empty, LAST, [LAST])
    with pytest.raises(ValueError):  # two days later, one of them not read
        advance(one, LAST, one, shift_day(LAST, -2), [shift_day(LAST, -2)])
    with pytest.raises(ValueError):
        advance(one, LAST, one, shift_day(LAST, 1), [shift_day(LAST, 1)])
    with pytest.raises(ValueError):
        advance(None, None, one, LAST, [LAST], widest=63)
