"""A retractable ledger of revenue: days are added, sent again and taken back without a recomputation.

Distinct users can't be summed, and a refund counts only while its order id has a payment on any
day. The ledger therefore keeps signed counts at the two grains where sums are enough:

* ``lines``: per (order id, group, user) how many order, payment and refund rows there are (kept by order row
  and added up where they are read). It decides which ids are paid.
* ``users``: per (group, user) what these lines add up to, refunds of unpaid ids left out. A user
  counts in a group while its count is above zero, so distinct users fold forward.

To replace a day is to apply its delta: the day's lines now, less its lines as last applied. The delta touches
some order ids, and where one turns paid or unpaid all its refunds move. What is merged into ``users`` is the difference.

``lines`` are stored once, by day and version under ``days``: the ledger's lines are the last version of
every day, so a step writes its own days only. Of the others it reads the payments' ids and the refunds.

Every step writes a new version beside the old one and then adds it to ``versions``, so a failed or
repeated step leaves the last version as it was. A hot order id is looked up first and its lines are
flagged in place, as in ``paid_refunds``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.operators.revenue import GROUP_KEYS, PAYMENT, REFUND, fold_user_lines, hot_ids
from playmart.sources.scratch import Scratch

AMOUNT = "decimal(31,2)"
# c_pay and c_ref count the amounts that aren't NULL: a sum of none is NULL, not zero.
COUNTS = ("n_od", "n_pay", "n_ids", "c_pay", "n_ref", "c_ref")
SUMS = ("pay", "ref")
# Each task writes a file a day; the lines of more days than these are gathered by day first.
FEW_DAYS = 32
IS_REFUND = "n_ref != 0 OR c_ref != 0 OR ref != 0"  # a changed price leaves the count alone


def order_lines(orders: DataFrame, keys=GROUP_KEYS, more: tuple = ()) -> DataFrame:
    """Counts and sums per order row: all that follows adds lines up, so those of one (``more``, order id, group, user)
    need not meet first."""
    pay, refund = F.col("order_type") == PAYMENT, F.col("order_type") == REFUND
    amount, zero = F.col("_amount"), F.lit(0).cast(AMOUNT)
    count = lambda kind: F.when(kind, 1).otherwise(0).cast("long")
    total = lambda kind: F.coalesce(F.when(kind, amount), zero)
    rows = orders.select(*more, F.col("order_id").cast("string").alias("order_id"), *keys, "uid", "order_type",
                         (F.col("coin_price") * F.col("coin_cnt")).cast(AMOUNT).alias("_amount"))
    return rows.withColumns({
        "n_od": F.lit(1).cast("long"),
        "n_pay": count(pay),
        "n_ids": count(pay & F.col("order_id").isNotNull()),
        "c_pay": count(pay & amount.isNotNull()),
        "n_ref": count(refund),
        "c_ref": count(refund & amount.isNotNull()),
        "pay": total(pay),
        "ref": total(refund),
    }).drop("order_type", "_amount")


def negated(lines: DataFrame) -> DataFrame:
    return lines.withColumns({c: (-F.col(c)).cast("long") for c in COUNTS} | {c: (-F.col(c)).cast(AMOUNT) for c in SUMS})


def merged(frames: list[DataFrame], by: list[str]) -> DataFrame:
    """The sums of all frames; rows that cancel out go."""
    rows = frames[0].select(*by, *COUNTS, *SUMS)
    for f in frames[1:]:
        rows = rows.unionByName(f.select(*by, *COUNTS, *SUMS))
    out = rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COUNTS], *[F.sum(c).cast(AMOUNT).alias(c) for c in SUMS])
    some: Column = F.lit(False)
    for c in (*COUNTS, *SUMS):
        some = some | (F.col(c) != 0)
    return out.where(some)


def user_delta(before: DataFrame, delta: DataFrame, scratch: Scratch, keys=GROUP_KEYS) -> list[DataFrame]:
    """What the lines ``delta`` add to ``users``, in parts to be merged. ``before``: the lines so far. Neither needs to be merged."""
    by = [*keys, "uid"]
    # Orders and payments change by the delta alone.
    plain = delta.withColumns({c: F.lit(0).cast("long") for c in ("n_ref", "c_ref")} | {"ref": F.lit(0).cast(AMOUNT)})
    # Refunds count while paid: those applied now, less those that counted before. Only ids in the delta can have changed.
    zero, known = F.lit(0).cast("long"), F.col("order_id").isNotNull()
    old, new = before.where(known), delta.where(known)
    pays = old.where("n_pay != 0").select("order_id", F.col("n_pay").alias("_old"), zero.alias("_add"), F.lit(False).alias("_hit"))
    pays = pays.unionByName(new.select("order_id", zero.alias("_old"), F.col("n_pay").alias("_add"), F.lit(True).alias("_hit")))
    paid = pays.groupBy("order_id").agg(
        (F.sum("_old") > 0).alias("_was"), (F.sum(F.col("_old") + F.col("_add")) > 0).alias("_is"), F.max("_hit").alias("_hit"))
    paid = scratch.keep(paid.where("_hit AND (_was OR _is)").drop("_hit"))
    cols = ["order_id", *by, "n_ref", "c_ref", "ref"]
    # Refunds that came before move only with ids that turn, mostly few; those of the delta count where the id is paid now.
    sides = [(old, paid.where("_was != _is").select("order_id", F.when(F.col("_is"), 1).otherwise(-1).alias("_s"))),
             (new, paid.where("_is").select("order_id", F.lit(1).alias("_s")))]
    refunds = [rows.where(IS_REFUND).select(*cols) for rows, _ in sides]
    hot = hot_ids(refunds[0].unionByName(refunds[1]), "order_id")
    parts = []
    for rows, (_, signs) in zip(refunds, sides, strict=True):
        if not hot:
            parts.append(rows.join(signs, "order_id"))
            continue
        parts.append(rows.where(~F.col("order_id").isin(hot)).join(signs, "order_id"))
        found = signs.where(F.col("order_id").isin(hot)).collect()
        for sign in {r["_s"] for r in found}:
            ids = [r["order_id"] for r in found if r["_s"] == sign]
            parts.append(rows.where(F.col("order_id").isin(ids)).withColumn("_s", F.lit(sign)))
    moved = parts[0]
    for part in parts[1:]:
        moved = moved.unionByName(part)
    moved = moved.withColumns({c: zero for c in ("n_od", "n_pay", "n_ids", "c_pay")} | {"pay": F.lit(0).cast(AMOUNT)}
                              | {c: F.col(c) * F.col("_s") for c in ("n_ref", "c_ref")} | {"ref": (F.col("ref") * F.col("_s")).cast(AMOUNT)})
    return [plain, moved]


def totals(users: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """``users`` -> the columns of ``revenue.group_table``."""
    shown = users.withColumns({"pay": F.when(F.col("c_pay") > 0, F.col("pay")), "ref": F.when(F.col("c_ref") > 0, F.col("ref"))})
    return fold_user_lines(shown, keys).where("n_od > 0")


class RevenueLedger:
    """The stored versions of a ledger at ``path``."""

    def __init__(self, spark: SparkSession, path: str, keys=GROUP_KEYS, key_types=("long", "int", "int")):
        self.spark, self.path, self.keys = spark, path, list(keys)
        group = ", ".join(f"{k} {t}" for k, t in zip(self.keys, key_types, strict=True))
        values = ", ".join([*[f"{c} long" for c in COUNTS], *[f"{c} {AMOUNT}" for c in SUMS]])
        self.user_ddl = f"{group}, uid string, {values}"
        self.line_ddl = f"order_id string, {self.user_ddl}"
        self.by = ["order_id", *self.keys, "uid"]

    def version(self) -> int:
        """The last complete version; 0 for a new ledger."""
        done = self._read("versions", "v long")
        return done.agg(F.max("v")).first()[0] or 0

    def _read(self, name: str, ddl: str) -> DataFrame:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], T.StructType.fromDDL(ddl))
        return self.spark.read.schema(ddl).parquet(f"{self.path}/{name}")

    def lines(self, version: int) -> DataFrame:
        return merged([self._lines(self._last(version))], self.by)

    def users(self, version: int | None = None) -> DataFrame:
        return self._read(f"users/v{self.version() if version is None else version}", self.user_ddl)

    def totals(self) -> DataFrame:
        return totals(self.users(), self.keys)

    def _stored(self) -> list[tuple[str, int]]:
        """The days and versions under ``days``, those of failed steps too."""
        return [(r["day"], r["v"]) for r in self._days().select("day", "v").distinct().collect()]

    def _last(self, version: int, stored: list[tuple[str, int]] | None = None) -> dict[str, int]:
        """Of every day, the last complete version that applied it, up to ``version``."""
        done = {r["v"] for r in self._read("versions", "v long").where(F.col("v") <= version).collect()}
        last: dict[str, int] = {}
        for day, v in self._stored() if stored is None else stored:
            if v in done:
                last[day] = max(v, last.get(day, 0))
        return last

    def _days(self) -> DataFrame:
        return self._read("days", f"{self.line_ddl}, day string, v long")

    def _lines(self, last: dict[str, int]) -> DataFrame:
        """The lines that the given versions applied for their days."""
        if not last:
            return self.spark.createDataFrame([], T.StructType.fromDDL(self.line_ddl))
        pairs = [f"{v}/{day}" for day, v in last.items()]
        return self._days().where(F.concat_ws("/", F.col("v").cast("string"), "day").isin(pairs)).drop("day", "v")

    def applied(self, days: list[str], version: int) -> DataFrame:
        """The lines of ``days`` as the versions up to ``version`` applied them last."""
        return self._lines({day: v for day, v in self._last(version).items() if day in set(days)})

    def replace_days(self, orders: DataFrame, days: list[str], day_col: str = "dt_data") -> int:
        """Make the ledger hold exactly ``orders`` for ``days`` (a day without rows is taken back). Returns the version."""
        days = sorted(set(days))
        if "" in days:
            raise ValueError("a day needs a name: an empty one can't be told from NULL where it is stored")
        v, stored = self.version(), self._stored()
        held = self._last(v, stored)
        new = max(v, *(k for _, k in stored), 0) + 1  # what a failed step left is never taken for this one's
        keys = [F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(self.line_ddl)]
        now = order_lines(orders.where(F.col(day_col).isin(days)), self.keys, (F.col(day_col).alias("day"),))
        # A day without rows still gets its version: one row of zeros.
        blank = self.spark.createDataFrame([(d,) for d in days], "day string").coalesce(1)
        blank = blank.select("day", *[F.lit(0 if f.name in (*COUNTS, *SUMS) else None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(self.line_ddl)])
        now = now.select("day", *keys).unionByName(blank).withColumn("v", F.lit(new).cast("long"))
        if len(days) > FEW_DAYS:
            now = now.hint("rebalance", "day")
        now.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "v").parquet(f"{self.path}/days")
        with Scratch(self.spark, "ledger") as scratch:
            # Lines of a day that comes for the first time are its delta; of a day sent again most lines cancel out.
            delta = self._lines({d: new for d in days if d not in held})
            again = [d for d in days if d in held]
            if again:
                changed = merged([self._lines(dict.fromkeys(again, new)), negated(self._lines({d: held[d] for d in again}))], self.by)
                delta = delta.unionByName(scratch.keep(changed))
            parts = user_delta(self._lines(held), delta, scratch, self.keys)
            merged([self.users(v), *parts], [*self.keys, "uid"]).write.mode("overwrite").parquet(f"{self.path}/users/v{new}")
            self.spark.createDataFrame([(new,)], "v long").coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        return new
