"""The factorised statistics table against the product written out row by row."""

import random

import pytest
from pyspark.sql import functions as F

from playmart.operators import fanout
from playmart.operators import revenue as rev

ORDERS = "mid long, p_type int, pkg_id int, m_type int, uid string, order_id string, order_type int, coin_price decimal(20,2), coin_cnt int"


def small_tables(spark, seed=1):
    rnd = random.Random(seed)
    orders = [(rnd.choice([1, 2, 3, 5, 9, None]), rnd.choice([None, 0, 1]), rnd.choice([None, 1, 2]), rnd.randrange(3),
               str(rnd.randrange(9)), rnd.choice([None, "null", *map(str, range(20))]), rnd.choice([1, 2, 3]), None, 1) for _ in range(120)]
    orders += [(7, 1, 1, 1, "u", "x", 3, None, 1)] * 3  # a machine with neither payments nor refunds
    df = spark.createDataFrame(orders, ORDERS).withColumn("coin_price", (F.col("pkg_id") + 2).cast("decimal(20,2)"))
    users = spark.createDataFrame([("u1", "1"), ("u2", "1"), ("u3", "5")], "uid string, reg_mid string")
    mb = spark.createDataFrame(
        [(1, "a", 0.5, 0.1, 0.2, 0.2, 4, "P", "C", "addr"), (1, "a2", 0.5, 0.1, 0.2, 0.2, 4, "P", "C", "addr"), (2, None, 0.5, 0.1, 0.2, 0.2, 4, "P", "C", "addr"),
         (3, "c", 0.25, 0.1, 0.2, 0.2, None, "P", "C", "addr"), (5, "e", 0.5, 0.1, 0.2, 0.2, 1, None, None, None), (7, "g", 0.1, 0.1, 0.1, 0.1, 2, "Q", "C", "x"), (8, "h", 0.1, 0.1, 0.1, 0.1, 2, "Q", "C", "x")],
        "mid long, machine_name string, inv_rate double, age_rate double, com_rate double, par_rate double, adminid int, province string, city string, address string")
    ml = spark.createDataFrame([(1, "GP", None, "T", "d"), (1, "GQ", None, "T", "d"), (3, None, "GC", "T", "d")], "mid long, province string, city string, township string, addressdetail string")
    return df, users, mb, ml


def product(orders, users, mb, ml):
    """The original joins, on the machine alone, numbered in the defined order."""
    from pyspark.sql import Window

    r = rev.revenue_groups(orders).select(F.col("mid").alias("rm"), F.col("pkg_id").alias("rp"), F.col("m_type").alias("rt"), *fanout.REVENUE_COLS)
    f = rev.refund_groups(orders).select(F.col("mid").alias("fm"), F.col("pkg_id").alias("fp"), F.col("m_type").alias("ft"), *fanout.REFUND_COLS)
    u = rev.machine_new_users(users, orders).withColumnRenamed("mid", "um")
    p = rev.machine_places(mb, ml).withColumnRenamed("mid", "pm")
    dims = [c for c in rev.STAT_DIM_COLS if c in p.columns]
    j = orders.join(r, F.col("mid") == F.col("rm"), "left").join(f, F.col("mid") == F.col("fm"), "left").join(u, F.col("mid") == F.col("um"), "left")
    j = j.join(p, F.col("mid") == F.col("pm"))
    order = ["mid", "p_type", "pkg_id", "m_type", "rp", "rt", "fp", "ft", *dims]
    j = j.withColumn("row_no", F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])) - 1)
    return j.select("row_no", "mid", "p_type", "pkg_id", rev.pay_label("m_type").alias("m_type"), *dims, *fanout.REVENUE_COLS, *fanout.REFUND_COLS, "new_user_cnt")



@pytest.fixture(scope="module")
def whole(spark):
    tables = small_tables(spark)
    return fanout.fanout_table(*tables), product(*tables)


def test_all_rows_and_any_interval(spark, whole):
    t, want = whole
    rows = {r[0]: r for r in map(tuple, want.select(*t.rows(0, 1).columns).collect())}
    n = t.count()
    assert n == len(rows) > 900
    assert {r[0]: tuple(r) for r in t.rows().collect()} == rows
    for lo, hi in ((0, 1), (5, 5), (n - 3, n), (n // 3, n // 3 + 500), (n - 10, n + 50)):
        got = {r[0]: tuple(r) for r in t.rows(lo, hi).collect()}
        assert got == {k: v for k, v in rows.items() if lo <= k < hi}


def test_blocks_keep_copies_together(spark, whole, monkeypatch):
    t, _ = whole
    n = t.count()
    blocks = t.blocks(0, n).collect()
    assert sum(b.n_rows for b in blocks) == n and any(b.n_rows > 1 for b in blocks) and len(blocks) < n
    monkeypatch.setattr(fanout, "COPIES_PER_BLOCK", 2)
    monkeypatch.setattr(fanout, "ROWS_PER_TASK", 100)
    assert sorted(r.row_no for r in t.rows().collect()) == list(range(n))


def test_sums_equal_the_weights(spark):
    tables = small_tables(spark, 3)
    t = fanout.fanout_table(*tables)
    sums = lambda df: {tuple(r)[0]: tuple(r)[1:] for r in df.collect()}
    cols = [c for c in rev.SUM_COLS]
    got = t.blocks(0, t.count()).groupBy("mid").agg(F.sum("n_rows").cast("long"), *[F.sum(F.col(c) * F.col("n_rows")).cast("double") for c in cols])
    want = rev.fanout_weights(*tables).groupBy("mid").agg(F.sum("n_rows").cast("long"), *[F.sum(c).cast("double") for c in cols])
    assert sums(got) == sums(want)


def test_one_order_group_of_many_copies(spark):
    """A machine whose orders are all alike: the copies are counted, not kept, and an interval costs its own rows."""
    orders, users, mb, ml = small_tables(spark)
    many = spark.range(0, 300_000, numPartitions=4).select(
        F.lit(5).cast("long").alias("mid"), F.lit(1).alias("p_type"), F.lit(1).alias("pkg_id"), F.lit(1).alias("m_type"), F.lit("u").alias("uid"),
        F.lit("o").alias("order_id"), F.lit(1).alias("order_type"), F.lit(2).cast("decimal(20,2)").alias("coin_price"), F.lit(1).alias("coin_cnt"))
    t = fanout.fanout_table(many, users, mb, ml)
    assert t.orders.count() == 1 and t.count() == 300_000
    assert sorted(r.row_no for r in t.rows(199_990, 200_010).collect()) == list(range(199_990, 200_010))


def test_written_and_read_and_empty(spark, tmpdir_path, whole):
    t, _ = whole
    t.write(f"{tmpdir_path}/factors")
    again = fanout.FanoutTable.read(spark, f"{tmpdir_path}/factors")
    key = lambda r: r[0]
    assert sorted(map(tuple, again.rows(100, 200).collect()), key=key) == sorted(map(tuple, t.rows(100, 200).collect()), key=key)
    _, users, mb, ml = small_tables(spark)
    empty = fanout.fanout_table(spark.createDataFrame([], ORDERS), users, mb, ml)
    assert empty.count() == 0 and empty.rows().count() == 0
