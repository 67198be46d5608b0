"""The original statistics table as a factorised table.

Joined on the machine alone, every order row of a machine meets all of its revenue groups, all of its
refund groups and all of its place rows. The product is never built: a machine's rows are
kept as four factors, each row numbered inside its machine, order rows that are alike once with their
count. The product's rows have one defined order

    machine, order group, revenue group, refund group, place row, copy

so the sizes alone say where each machine starts, and any interval of row numbers is
unranked factor by factor: at each step only the blocks that meet the interval go on.
The work for an interval is that of its machines' factors plus its own rows.

A machine without revenue or refund groups has one empty group there, as in the original's left joins;
machines without a usable dimension row, and orders without a machine, have no rows. Order groups
sort by package kind, package and pay type, revenue and refund groups by package and pay type, place
rows by all their columns; NULLs come first. Rows that are alike in every column are copies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playmart.operators import revenue as rev
from playmart.operators.ranking import prefix_sums
from playmart.operators.relational import pay_label
from playmart.sources.scratch import Scratch

REVENUE_COLS = ("total_user_cnt", "total_order_cnt", "total_revenue")
REFUND_COLS = ("total_user_refund_cnt", "total_order_refund_cnt", "total_refund")
FACTORS = ("machines", "orders", "revenue", "refunds", "places")
# Rows of one order group are written out in blocks of this many, several blocks a task.
COPIES_PER_BLOCK = 100_000
ROWS_PER_TASK = 2_000_000


def _numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Numbers from 0 inside each machine; a machine's groups are bounded by its packages and pay types."""
    w = Window.partitionBy("mid").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(out, F.row_number().over(w) - 1)


def _meets(first: str, size, lo: int, hi: int):
    return (F.col(first) < F.lit(hi)) & (F.col(first) + size > F.lit(lo))


@dataclass
class FanoutTable:
    """machines: mid, start, size, n_rev, n_ref, n_place, new_user_cnt. orders: mid, before, n, the
    order columns. revenue, refunds, places: mid, number in the machine, their columns."""

    machines: DataFrame
    orders: DataFrame
    revenue: DataFrame
    refunds: DataFrame
    places: DataFrame

    def count(self) -> int:
        """Rows of the whole product."""
        return int(self.machines.agg(F.sum("size")).first()[0] or 0)

    def machine_starts(self, lo: int, hi: int) -> DataFrame:
        """The machines with rows in [lo, hi): mid, start, size."""
        return self.machines.where(_meets("start", F.col("size"), lo, hi)).select("mid", "start", "size")

    def blocks(self, lo: int, hi: int) -> DataFrame:
        """Rows [lo, hi) with copies together: every column, ``row_no`` of the first and ``n_rows``."""
        m = self.machines.where(_meets("start", F.col("size"), lo, hi))
        # Sizes of the blocks below an order row, a revenue group and a refund group.
        rf, ff, pf = F.greatest("n_rev", F.lit(1)), F.greatest("n_ref", F.lit(1)), F.col("n_place")
        o = self.orders.join(m.drop("size"), "mid").withColumn("at", F.col("start") + F.col("before") * rf * ff * pf)
        o = o.where(_meets("at", F.col("n") * rf * ff * pf, lo, hi))

        def step(df: DataFrame, factor: DataFrame, number: str, below, how: str) -> DataFrame:
            j = df.join(factor, "mid", how)
            j = j.withColumn("at", F.col("at") + F.coalesce(F.col(number), F.lit(0)) * F.col("n") * below)
            return j.where(_meets("at", F.col("n") * below, lo, hi)).drop(number)

        r = step(o, self.revenue, "rev_no", ff * pf, "left")
        r = step(r, self.refunds, "ref_no", pf, "left")
        r = step(r, self.places, "place_no", F.lit(1), "inner")
        first = F.greatest("at", F.lit(lo))
        r = r.withColumn("row_no", first).withColumn("n_rows", F.least(F.col("at") + F.col("n"), F.lit(hi)) - first)
        places = [c for c in self.places.columns if c not in ("mid", "place_no")]
        return r.select(
            "row_no", "n_rows", "mid", "p_type", "pkg_id", pay_label("m_type").alias("m_type"), *places, *REVENUE_COLS, *REFUND_COLS, "new_user_cnt"
        )

    def rows(self, lo: int = 0, hi: int | None = None) -> DataFrame:
        """Rows [lo, hi) of the product, one each, with their number ``row_no`` (``hi=None``: to the end)."""
        hi = self.count() if hi is None else hi
        b = self.blocks(lo, hi)
        step = F.lit(COPIES_PER_BLOCK)
        parts = b.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_rows") - 1) / step))))
        tasks = max(1, (hi - lo) // ROWS_PER_TASK)
        if tasks > 1:  # an order group of many copies is dealt out before it is written out
            parts = parts.repartition(tasks)
        n = F.least(step, F.col("n_rows") - F.col("part") * step)
        out = parts.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
        row_no = F.col("row_no") + F.col("part") * step + F.col("copy")
        return out.select(row_no.alias("row_no"), *[c for c in b.columns if c not in ("row_no", "n_rows")])

    def write(self, path: str) -> None:
        for name in FACTORS:
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> FanoutTable:
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in FACTORS])


def fanout_table(orders: DataFrame, users: DataFrame, mb: DataFrame, ml: DataFrame | None = None, scratch: Scratch | None = None) -> FanoutTable:
    """The factors of the mid-only statistics join (its arguments are those of ``fanout_weights``)."""
    scratch = scratch or Scratch(orders.sparkSession, "fanout")
    known = F.col("mid").isNotNull()
    groups = scratch.keep(rev.group_table(orders).where(known))
    revenue = scratch.keep(_numbered(groups.where("n_pay > 0").select(*rev.GROUP_KEYS, *REVENUE_COLS), ["pkg_id", "m_type"], "rev_no").drop("pkg_id", "m_type"))
    refunds = scratch.keep(_numbered(groups.where("n_ref > 0").select(*rev.GROUP_KEYS, *REFUND_COLS), ["pkg_id", "m_type"], "ref_no").drop("pkg_id", "m_type"))
    place_rows = rev.machine_places(mb, ml)
    dims = [c for c in rev.STAT_DIM_COLS if c in place_rows.columns]
    places = scratch.keep(_numbered(place_rows.where(known).select("mid", *dims), dims, "place_no"))
    alike = orders.where(known).groupBy("mid", "p_type", "pkg_id", "m_type").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("mid").orderBy(*[F.col(c).asc_nulls_first() for c in ("p_type", "pkg_id", "m_type")]).rowsBetween(Window.unboundedPreceding, -1)
    order_groups = scratch.keep(alike.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))

    def counted(df: DataFrame, out: str, value=F.count(F.lit(1))) -> DataFrame:
        return df.groupBy("mid").agg(value.alias(out))

    m = counted(order_groups, "n_od", F.sum("n")).join(counted(places, "n_place"), "mid")
    m = m.join(counted(revenue, "n_rev"), "mid", "left").join(counted(refunds, "n_ref"), "mid", "left")
    m = m.na.fill(0, ["n_rev", "n_ref"]).join(rev.machine_new_users(users, orders), "mid", "left")
    size = F.col("n_od") * F.greatest("n_rev", F.lit(1)) * F.greatest("n_ref", F.lit(1)) * F.col("n_place")
    machines = prefix_sums(m.withColumn("size", size), ["mid"], "size", "start", scratch=scratch)
    return FanoutTable(machines.drop("n_od"), order_groups, revenue, refunds, places)
