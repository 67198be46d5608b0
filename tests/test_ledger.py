"""The ledger against a full recomputation after every step."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from playmart.operators import ledger as L
from playmart.operators import revenue as rev

DDL = "mid long, pkg_id int, m_type int, uid string, order_id string, order_type int, price int, dt_data string"
COLS = ["mid", "pkg_id", "m_type", "n_od", "n_pay", "total_user_cnt", "total_order_cnt", "total_revenue",
        "n_ref", "total_user_refund_cnt", "total_order_refund_cnt", "total_refund"]


def day_rows(day, seed, n=150):
    rnd = random.Random(f"{day}{seed}")
    return [(rnd.choice([1, 2, None]), rnd.choice([1, None]), rnd.randrange(2), rnd.choice([None, "a", "b", "c", "d"]),
             rnd.choice([None, "null", "null", *map(str, range(30))]), rnd.choice([1, 2, 2, 3]), rnd.choice([None, 5, 7]), day) for _ in range(n)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, DDL)
    return df.withColumn("coin_price", F.col("price").cast("decimal(20,2)")).withColumn("coin_cnt", F.lit(1)).drop("price")


def rows_of(df):
    return sorted(map(tuple, df.select(*COLS).collect()), key=str)


def test_days_added_replaced_late_and_taken_back(spark, tmpdir_path):
    ledger = L.RevenueLedger(spark, f"{tmpdir_path}/ledger")
    assert ledger.version() == 0 and ledger.totals().count() == 0
    held = {}
    steps = [{"d1": 1, "d2": 1}, {"d4": 1}, {"d2": 2}, {"d3": 1}, {"d1": 3, "d4": 2}, {"d2": None}, {"d3": 1}, {"d5": None}]
    for step in steps:
        rows = [r for day, seed in step.items() if seed for r in day_rows(day, seed)]
        ledger.replace_days(frame(spark, rows + day_rows("elsewhere", 1)), list(step))
        held |= {day: day_rows(day, seed) if seed else [] for day, seed in step.items()}
        every = [r for rows in held.values() for r in rows]
        assert rows_of(ledger.totals()) == rows_of(rev.group_table(frame(spark, every))), step
    assert ledger.version() == len(steps)


def test_a_refund_counts_only_while_its_order_is_paid(spark, tmpdir_path):
    ledger = L.RevenueLedger(spark, f"{tmpdir_path}/ledger")
    refund, payment = (1, 1, 1, "u", "o", 2, 5, "d1"), (1, 1, 1, "u", "o", 1, 9, "d2")
    seen = lambda: ledger.totals().select("total_revenue", "total_refund", "total_user_refund_cnt").first()
    ledger.replace_days(frame(spark, [refund]), ["d1"])
    assert seen().total_refund is None
    ledger.replace_days(frame(spark, [payment]), ["d2"])
    assert (int(seen().total_refund), seen().total_user_refund_cnt) == (5, 1)
    ledger.replace_days(frame(spark, []), ["d2"])  # the payment is taken back
    assert seen().total_refund is None and seen().total_revenue is None


@pytest.mark.parametrize("failed", ["users", "versions"])
def test_a_failed_step_changes_nothing(spark, tmpdir_path, failed, monkeypatch):
    ledger = L.RevenueLedger(spark, f"{tmpdir_path}/ledger")
    ledger.replace_days(frame(spark, day_rows("d1", 1)), ["d1"])
    before = rows_of(ledger.totals())
    # What a step that died before its last write leaves behind.
    left = ledger.users(1).limit(3)
    left.write.parquet(f"{tmpdir_path}/ledger/users/v2")
    if failed == "versions":
        bad = ledger.lines(1).limit(2).withColumn("day", F.lit("d1")).withColumn("v", F.lit(2).cast("long"))
        bad.write.mode("append").partitionBy("day", "v").parquet(f"{tmpdir_path}/ledger/days")
    assert rows_of(ledger.totals()) == before
    ledger.replace_days(frame(spark, day_rows("d1", 2)), ["d1"])
    assert rows_of(ledger.totals()) == rows_of(rev.group_table(frame(spark, day_rows("d1", 2))))


def test_a_step_stores_its_own_days_only(spark, tmpdir_path):
    ledger = L.RevenueLedger(spark, f"{tmpdir_path}/ledger")
    ledger.replace_days(frame(spark, day_rows("d1", 1, 600) + day_rows("d2", 1, 600)), ["d1", "d2"])
    stored = lambda: sum(spark.read.parquet(str(p)).count() for p in pathlib.Path(ledger.path).rglob("*.parquet") if "users" not in p.parts)
    before = stored()
    ledger.replace_days(frame(spark, day_rows("d3", 1, 40)), ["d3"])
    assert 0 < stored() - before <= 40 + 2  # the day's lines, its row of zeros and the version


def test_days_of_a_failed_step_are_never_taken_for_a_later_ones(spark, tmpdir_path):
    ledger = L.RevenueLedger(spark, f"{tmpdir_path}/ledger")
    ledger.replace_days(frame(spark, day_rows("d1", 1)), ["d1"])
    # A step of d2 died before its version was complete; the next one sends d3.
    left = frame(spark, day_rows("d2", 1))
    left = L.order_lines(left, more=(F.col("dt_data").alias("day"),)).withColumn("v", F.lit(2).cast("long"))
    left.write.mode("append").partitionBy("day", "v").parquet(f"{tmpdir_path}/ledger/days")
    ledger.replace_days(frame(spark, day_rows("d3", 1)), ["d3"])
    ledger.replace_days(frame(spark, day_rows("d2", 2)), ["d2"])
    every = day_rows("d1", 1) + day_rows("d3", 1) + day_rows("d2", 2)
    assert rows_of(ledger.totals()) == rows_of(rev.group_table(frame(spark, every)))


def test_many_days_and_a_hot_order(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(L, "FEW_DAYS", 2)
    ledger = L.RevenueLedger(spark, f"{tmpdir_path}/ledger")
    days = [f"d{k}" for k in range(14)]
    refunds = [(1, 1, 1, f"u{k}", "hot", 2, 5, days[k % 14]) for k in range(200)]
    ledger.replace_days(frame(spark, refunds + [r for d in days for r in day_rows(d, 1, 20)]), days)
    pay = (1, 1, 1, "u", "hot", 1, 9, "late")
    ledger.replace_days(frame(spark, [pay]), ["late"])
    every = [*refunds, *[r for d in days for r in day_rows(d, 1, 20)]]
    assert rows_of(ledger.totals()) == rows_of(rev.group_table(frame(spark, [*every, pay])))
    ledger.replace_days(frame(spark, []), ["late"])
    assert rows_of(ledger.totals()) == rows_of(rev.group_table(frame(spark, every)))
    with pytest.raises(ValueError):
        ledger.replace_days(frame(spark, []), [""])
