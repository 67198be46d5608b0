"""Order cleaning, per-machine revenue / refund statistics, province and
operator marts, revenue shares.

The original joins every order row of a machine to ALL of that machine's
revenue groups and refund groups (join on ``mid`` only), so its statistics
table holds orders x revenue groups x refund groups rows per machine. That
product is never materialised here:

* ``machine_statistics`` joins at the group grain (mid, pkg_id, m_type): one
  output row per order row, no fan-out.
* ``fanout.fanout_table`` holds the product as factors and gives any interval of its rows.
* ``fanout_weights`` gives, per (machine, pay type, machine-dimension row),
  the exact row count and column sums the fan-out would have produced, from
  per-machine aggregates (multiplicities are products of group counts).
  ``province_revenue`` and ``operator_share`` consume these weights, so their
  totals equal the original's without emitting pairs.

Every aggregate is partial (map-side) before its shuffle; joins are between
per-machine aggregates and machine dimensions, whose size is bounded by the
number of machines, not by the number of orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmart.functions.scoring import share
from playmart.operators.relational import abs_amount, pay_label, recode_order_type, semi_join

MONEY = "decimal(20,2)"
RATE = "decimal(10,2)"
PAYMENT, REFUND = 1, 2
GROUP_KEYS = ("mid", "pkg_id", "m_type")
RATE_COLS = ("com_rate", "par_rate", "inv_rate", "age_rate")
# Share column per rate column.
SHARE_NAMES = {"com_rate": "company", "par_rate": "partner", "inv_rate": "investor", "age_rate": "operator"}


def clean_orders(raw: DataFrame) -> DataFrame:
    """Raw consume records -> clean orders: positive ``coin_price``, ``coin_cnt``
    = 1, order type recoded (1 payment, 2 refund, 3 other)."""
    passthrough = [c for c in raw.columns if c not in ("amount", "order_type")]
    return raw.select(
        *passthrough,
        abs_amount("amount").cast(MONEY).alias("coin_price"),
        F.lit(1).alias("coin_cnt"),
        recode_order_type("order_type").alias("order_type"),
    )


def _amount() -> Column:
    return F.col("coin_price") * F.col("coin_cnt")


def revenue_groups(orders: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """Payments per group: distinct users, orders, revenue."""
    return (
        orders.where(F.col("order_type") == PAYMENT)
        .groupBy(*keys)
        .agg(
            F.count_distinct("uid").alias("total_user_cnt"),
            F.count("order_id").alias("total_order_cnt"),
            F.sum(_amount()).cast(MONEY).alias("total_revenue"),
        )
    )


def order_groups(orders: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """All order rows per group (``n_od``) with the payment aggregates of
    ``revenue_groups`` (``n_pay`` = payment rows) in a single aggregation."""
    pay = F.col("order_type") == PAYMENT
    return orders.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_od"),
        F.count_if(pay).alias("n_pay"),
        F.count_distinct(F.when(pay, F.col("uid"))).alias("total_user_cnt"),
        F.count(F.when(pay, F.col("order_id"))).alias("total_order_cnt"),
        F.sum(F.when(pay, _amount())).cast(MONEY).alias("total_revenue"),
    )


# An order id held by at least one in HOT_IDS refund rows is hot; a bounded counter finds these.
HOT_IDS, HOT_TRACKED = 1_000, 10_000


def hot_ids(rows: DataFrame, id_col: str) -> list:
    """The ids held by at least 1 / HOT_IDS of the rows, so at most HOT_IDS values.

    One pass with a counter of HOT_TRACKED entries a task, merged by Spark: nothing is
    shuffled by id. The counter may miss an id that is only just hot, never a larger one.
    """
    top = F.expr(f"approx_top_k(`{id_col}`, {HOT_IDS}, {HOT_TRACKED})")
    found = rows.where(F.col(id_col).isNotNull()).agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [x["item"] for x in found["top"] or [] if x["count"] * HOT_IDS >= found["n"]]


def paid_refunds(orders: DataFrame) -> DataFrame:
    """Refund rows whose order id also has a payment (a NULL id has none).

    Only refund rows and distinct paid ids meet by id. A hot id would bring all its refund rows to one
    task, so the few hot ids are looked up first and their rows filtered in place; of the
    other ids none has more than 1 / HOT_IDS of the rows.
    """
    key = F.col("order_id")
    # Distinct paid ids: deduplicated map-side, and the shuffle that does it is
    # already partitioned by order_id for the semi join.
    paid = orders.where(F.col("order_type") == PAYMENT).select("order_id").distinct()
    refunds = orders.where(F.col("order_type") == REFUND)
    hot = hot_ids(refunds, "order_id")
    if not hot:
        return semi_join(refunds, paid, "order_id")
    hot_paid = [r[0] for r in paid.where(key.isin(hot)).collect()]
    rest = semi_join(refunds.where(~key.isin(hot)), paid.where(~key.isin(hot)), "order_id")
    return rest.unionByName(refunds.where(key.isin(hot_paid))) if hot_paid else rest


def refund_groups(orders: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """Refunds per group, counting only refunds whose order id also has a payment."""
    return paid_refunds(orders).groupBy(*keys).agg(
        F.count_distinct("uid").alias("total_user_refund_cnt"),
        F.count("order_id").alias("total_order_refund_cnt"),
        F.sum(_amount()).cast(MONEY).alias("total_refund"),
    )


def user_lines(orders: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """Per (group, user): ``n_od`` order rows, ``n_pay`` payments, ``n_ids`` of them with an order id, their
    amount ``pay``, ``n_ref`` refunds of paid orders and their amount ``ref`` (NULL where all amounts are).

    Payments are summed where they are read and never travel by order id.
    """
    keys, pay = list(keys), F.col("order_type") == PAYMENT
    none = F.lit(None).cast("decimal(31,2)")
    amount = _amount().cast("decimal(31,2)")
    rows = orders.select(
        *keys, "uid", F.lit(1).alias("n_od"), F.when(pay, 1).otherwise(0).alias("n_pay"),
        F.when(pay & F.col("order_id").isNotNull(), 1).otherwise(0).alias("n_ids"), F.when(pay, amount).alias("pay"),
        F.lit(0).alias("n_ref"), none.alias("ref"),
    )
    back = paid_refunds(orders).select(
        *keys, "uid", *[F.lit(0).alias(c) for c in ("n_od", "n_pay", "n_ids")], none.alias("pay"), F.lit(1).alias("n_ref"),
        amount.alias("ref"),
    )
    sums = ("n_od", "n_pay", "n_ids", "n_ref")
    return rows.unionByName(back).groupBy(*keys, "uid").agg(
        *[F.sum(c).alias(c) for c in sums], *[F.sum(c).cast("decimal(31,2)").alias(c) for c in ("pay", "ref")])


def fold_user_lines(lines: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """``user_lines`` -> per group, the columns of ``group_table``."""
    keys, known = list(keys), F.col("uid").isNotNull()
    out = lines.groupBy(*keys).agg(
        F.sum("n_od").alias("n_od"),
        F.sum("n_pay").alias("n_pay"),
        F.count_if(known & (F.col("n_pay") > 0)).alias("_users"),
        F.sum("n_ids").alias("_ids"),
        F.sum("pay").cast(MONEY).alias("_pay"),
        F.sum("n_ref").alias("n_ref"),
        F.count_if(known & (F.col("n_ref") > 0)).alias("_rusers"),
        F.sum("ref").cast(MONEY).alias("_ref"),
    )
    has_pay, has_ref = F.col("n_pay") > 0, F.col("n_ref") > 0
    return out.select(
        *keys, "n_od", "n_pay",
        F.when(has_pay, F.col("_users")).alias("total_user_cnt"),
        F.when(has_pay, F.col("_ids")).alias("total_order_cnt"),
        F.col("_pay").alias("total_revenue"),
        "n_ref",
        F.when(has_ref, F.col("_rusers")).alias("total_user_refund_cnt"),
        F.when(has_ref, F.col("n_ref")).alias("total_order_refund_cnt"),
        F.col("_ref").alias("total_refund"),
    )


def group_table(orders: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """Order rows, payments and refunds per group.

    Columns: ``n_od`` (all order rows), ``n_pay`` and ``n_ref`` (payment rows; refund
    rows whose order id also has a payment), and the columns of ``revenue_groups`` and
    ``refund_groups``, NULL where the group has no such row.
    """
    return fold_user_lines(user_lines(orders, keys), keys)


def new_users(users: DataFrame, reg_mid: str = "reg_mid") -> DataFrame:
    """Distinct registered users per registration machine."""
    return users.groupBy(F.col(reg_mid).alias("mid")).agg(F.count_distinct("uid").alias("new_user_cnt"))


def machine_new_users(users: DataFrame, orders: DataFrame) -> DataFrame:
    """``new_users`` keyed with the orders' machine-id type."""
    nu = new_users(users)
    return nu.withColumn("mid", F.col("mid").cast(orders.schema["mid"].dataType))


def machine_dim(machines: DataFrame) -> DataFrame:
    """Machines that can carry revenue: named and with an investor rate.
    Rates are conformed to decimal(10,2) as in the statistics table."""
    cols = [F.col(c).cast(RATE).alias(c) if c in RATE_COLS else F.col(c) for c in machines.columns]
    return machines.where(F.col("machine_name").isNotNull() & F.col("inv_rate").isNotNull()).select(*cols)


def machine_places(mb: DataFrame, ml: DataFrame | None) -> DataFrame:
    """Machine rows with their location, geo fields first then registered ones."""
    mb = machine_dim(mb)
    if ml is None:
        return mb.withColumn("township", F.col("address")).withColumn("addressdetail", F.lit(None).cast("string"))
    loc = ml.select(
        F.col("mid").alias("_lmid"),
        F.col("province").alias("_lprov"),
        F.col("city").alias("_lcity"),
        F.col("township").alias("_ltown"),
        F.col("addressdetail"),
    )
    j = mb.join(loc, mb["mid"] == loc["_lmid"], "left")
    return j.select(
        *[c for c in mb.columns if c not in ("province", "city")],
        F.coalesce("_lprov", mb["province"]).alias("province"),
        F.coalesce("_lcity", mb["city"]).alias("city"),
        F.coalesce("_ltown", mb["address"]).alias("township"),
        "addressdetail",
    )


# The dimension columns of the statistics table.
STAT_DIM_COLS = (
    "machine_name", "store_address", "package_num", "package_name", "pay_switch",
    "sub_scence_cate_name", "sub_scence_name", "brand_name", "sub_brand_name", "adminid",
    "inv_rate", "age_rate", "com_rate", "par_rate", "province", "city", "township", "addressdetail",
)


def machine_statistics(
    orders: DataFrame,
    users: DataFrame,
    mb: DataFrame,
    ml: DataFrame | None = None,
    keys=GROUP_KEYS,
) -> DataFrame:
    """Per order row: its group's revenue / refund totals, machine new users,
    machine dimension and location. Joins at the group grain ``keys`` (must
    include mid, pkg_id and m_type: the mid-only fan-out is in
    ``fanout_weights``). Machines without a usable dimension row are dropped.
    """
    keys = tuple(keys)
    if not set(GROUP_KEYS) <= set(keys):
        raise ValueError("keys must contain mid, pkg_id and m_type; the mid-only join is fanout.fanout_table (rows) and fanout_weights (sums)")
    places = machine_places(mb, ml)
    dims = [c for c in STAT_DIM_COLS if c in places.columns]
    # All joins happen at the group and machine grain; the order rows are joined once, to the result.
    grp = group_table(orders, keys).withColumnsRenamed({k: f"_{k}" for k in keys})
    matched = F.lit(True)
    for k in keys:  # a NULL key matches no group in the original's join
        matched = matched & F.col(f"_{k}").isNotNull()
    totals = ["total_user_cnt", "total_order_cnt", "total_revenue",
              "total_user_refund_cnt", "total_order_refund_cnt", "total_refund"]
    grp = grp.select(*[f"_{k}" for k in keys], *[F.when(matched, F.col(c)).alias(c) for c in totals])
    people = machine_new_users(users, orders).withColumnRenamed("mid", "_umid")
    info = (
        grp.join(people, grp["_mid"] == people["_umid"], "left")
        .join(places.select(F.col("mid").alias("_pmid"), *dims), F.col("_mid") == F.col("_pmid"), "inner")
        .drop("_umid", "_pmid")
    )
    od = orders.select("mid", "p_type", "pkg_id", "m_type", *[k for k in keys if k not in GROUP_KEYS])
    same = F.col("mid") == F.col("_mid")
    for k in keys:
        if k != "mid":
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return od.join(info, same).select(
        "mid", "p_type", "pkg_id", pay_label("m_type").alias("m_type"), *dims, *totals, "new_user_cnt"
    )


# The summed columns of the statistics table.
SUM_COLS = (
    "total_user_cnt", "total_order_cnt", "total_revenue",
    "total_user_refund_cnt", "total_order_refund_cnt", "total_refund", "new_user_cnt",
)


def fanout_weights(orders: DataFrame, users: DataFrame, mb: DataFrame, ml: DataFrame | None = None) -> DataFrame:
    """Exact sums of the mid-only fan-out, one row per (mid, m_type, place).

    For a machine with n_od order rows of a pay type, revenue groups R and
    refund groups F, the fan-out holds n_od * max(1,|R|) * max(1,|F|) rows
    per place row; each revenue group's value repeats n_od * max(1,|F|) times,
    each refund group's n_od * max(1,|R|) times, new users on every row.
    Columns: mid, m_type (label), place columns, ``n_rows`` and the SUM_COLS
    holding the column sums over those rows (NULL where all values are NULL).
    """
    # One row per (machine, pay type) with its own groups' sums, then the sums over the
    # machine's few pay types: no self join, so the orders are read once.
    own = group_table(orders).groupBy("mid", "m_type").agg(
        F.sum("n_od").alias("n_od"),
        F.count_if(F.col("n_pay") > 0).alias("n_rev"),
        F.sum("total_user_cnt").alias("r_users"),
        F.sum("total_order_cnt").alias("r_orders"),
        F.sum("total_revenue").alias("r_revenue"),
        F.count_if(F.col("n_ref") > 0).alias("n_ref"),
        F.sum("total_user_refund_cnt").alias("f_users"),
        F.sum("total_order_refund_cnt").alias("f_orders"),
        F.sum("total_refund").alias("f_refund"),
    )
    over = Window.partitionBy("mid")
    sums = ("n_rev", "r_users", "r_orders", "r_revenue", "n_ref", "f_users", "f_orders", "f_refund")
    od = own.select("mid", "m_type", "n_od", *[F.sum(c).over(over).alias(c) for c in sums])
    w = od.join(machine_new_users(users, orders), "mid", "left")
    rp = F.greatest(F.coalesce("n_rev", F.lit(0)), F.lit(1))
    fp = F.greatest(F.coalesce("n_ref", F.lit(0)), F.lit(1))
    n = F.col("n_od")
    w = w.select(
        "mid",
        pay_label("m_type").alias("m_type"),
        (n * rp * fp).alias("n_rows"),
        (n * fp * F.col("r_users")).alias("total_user_cnt"),
        (n * fp * F.col("r_orders")).alias("total_order_cnt"),
        (F.col("r_revenue") * (n * fp)).alias("total_revenue"),
        (n * rp * F.col("f_users")).alias("total_user_refund_cnt"),
        (n * rp * F.col("f_orders")).alias("total_order_refund_cnt"),
        (F.col("f_refund") * (n * rp)).alias("total_refund"),
        (n * rp * fp * F.col("new_user_cnt")).alias("new_user_cnt"),
    )
    places = machine_places(mb, ml)
    return w.join(places, "mid", "inner")


def province_machine_count(machines: DataFrame) -> DataFrame:
    """Machines per province (count of non-NULL mid; NULL province is a group)."""
    return machines.groupBy("province").agg(F.count("mid").alias("mac_cnt"))


def province_revenue(stats: DataFrame) -> DataFrame:
    """Six sums per province, from ``fanout_weights`` (the original's totals)
    or from per-row ``machine_statistics``: both carry the same columns."""
    return stats.groupBy("province").agg(
        F.sum("total_user_cnt").cast("long").alias("province_UserCnt"),
        F.sum("new_user_cnt").cast("long").alias("province_RegUserCnt"),
        F.sum("total_order_cnt").cast("long").alias("province_OrderCnt"),
        F.sum("total_revenue").cast("decimal(38,2)").alias("province_Revenue"),
        F.sum("total_order_refund_cnt").cast("long").alias("province_RefundOrderCnt"),
        F.sum("total_refund").cast("decimal(38,2)").alias("province_Refund"),
    )


def operator_share(stats: DataFrame, distinct_rates: bool = False) -> DataFrame:
    """Per (operator, pay type) totals and the four revenue shares.

    The original left-joins each total back to every statistics row of the
    operator, so a total repeats once per row with that row's rates. Here each
    distinct (total, rates) result appears once with ``n_rows`` = how many
    times the original emits it (``distinct_rates=True``: n_rows = 1).
    An operator key of NULL matches nothing: one row per pay type, NULL shares.
    ``stats`` is ``fanout_weights`` output (``n_rows`` present) or per-row
    ``machine_statistics`` (each row counts once).
    """
    if "n_rows" not in stats.columns:
        stats = stats.withColumn("n_rows", F.lit(1).cast("long"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    # One aggregation feeds both sides (its shuffle is shared), so the
    # statistics input is evaluated once.
    base = stats.groupBy("adminid", "m_type", *RATE_COLS).agg(
        F.sum(z("total_order_cnt")).alias("_o"),
        F.sum(z("total_order_refund_cnt")).alias("_ro"),
        F.sum(z("total_revenue")).alias("_r"),
        F.sum(z("total_refund")).alias("_f"),
        F.sum("n_rows").alias("_n"),
    )
    totals = base.groupBy("adminid", F.col("m_type").alias("pay_type")).agg(
        F.sum("_o").cast("long").alias("total_order_count"),
        F.sum("_ro").cast("long").alias("total_refund_order_count"),
        F.sum("_r").cast(MONEY).alias("total_revenue"),
        F.sum("_f").cast(MONEY).alias("total_refund_revenue"),
    )
    detail = base.groupBy(F.col("adminid").alias("_aid"), *RATE_COLS).agg(F.sum("_n").alias("_n"))
    j = totals.join(detail, totals["adminid"] == detail["_aid"], "left")
    shares = [
        share("total_revenue", "total_refund_revenue", rate).alias(SHARE_NAMES[rate]) for rate in RATE_COLS
    ]
    out = j.select(
        "adminid", "pay_type", "total_order_count", "total_refund_order_count",
        "total_revenue", "total_refund_revenue", *shares,
        F.coalesce(F.col("_n"), F.lit(1)).cast("long").alias("_n"),
    )
    keys = [c for c in out.columns if c != "_n"]
    # Different rates can give equal shares (e.g. zero net revenue): merge them.
    n_rows = F.lit(1).cast("long") if distinct_rates else F.sum("_n").cast("long")
    return out.groupBy(*keys).agg(n_rows.alias("n_rows"))
