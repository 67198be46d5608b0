"""Registered revenue and machine queries on the driver tables.

lineitem ⨝ orders are the payment orders, supplier (+ nation, region) the
machines, customer the registered users.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from playmart.operators import revenue as rev
from playmart.operators.fanout import fanout_table
from playmart.operators.ledger import RevenueLedger
from playmart.operators.users import unify_users
from playmart.plans.driver_tables import table
from playmart.plans.q_text import MACHINE_LOCAL, MACHINE_UNION_SELECT, machine_local, machine_locations
from playmart.session import scratch_path


def raw_orders(spark, d):
    """Consume records: one per line item, amount negative for 'R' lines."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("o_custkey").cast("string").alias("uid"),
        F.col("l_suppkey").alias("mid"),
        (F.col("l_partkey") % 3).cast("int").alias("p_type"),
        (F.col("l_orderkey") % 9).cast("int").alias("m_type"),
        F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("action_time"),
        F.col("l_linenumber").alias("pkg_id"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("amount"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3).alias("order_type"),
    )


def clean(spark, d):
    return rev.clean_orders(raw_orders(spark, d))


def channel_sources(spark, d):
    """customer split into the four registration channels by c_custkey % 4."""
    c = table(spark, d, "customer")
    base = c.select(
        F.col("c_custkey").cast("string").alias("uid"),
        F.col("c_nationkey").cast("string").alias("reg_mid"),
        F.col("c_name").alias("_ref"),
        F.col("c_mktsegment").alias("sex"),
        (F.col("c_custkey") % 4).alias("_ch"),
    )
    pick = lambda k: base.where(F.col("_ch") == k)
    return {
        "wechat": pick(0).withColumnRenamed("_ref", "wxid").withColumn("msisdn", F.lit("139")),
        "alipay": pick(1).withColumnRenamed("_ref", "openid").withColumn("msisdn", F.lit("138")),
        "QQ": pick(2).withColumnRenamed("_ref", "openid").withColumn("msisdn", F.lit("137")),
        "app": pick(3).withColumnRenamed("_ref", "app_uid").withColumn("phone_number", F.lit("136")),
    }


def users(spark, d):
    return unify_users(channel_sources(spark, d))


def machine_tables(spark, d):
    """The five machine source tables, derived from supplier / nation / region."""
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    k = F.col("s_suppkey")
    storemap = s.select(
        k.alias("machine_num"),
        F.col("s_nationkey").alias("store_id"),
        F.when(k % 10 == 9, F.lit(None)).otherwise(k % 4).cast("int").alias("adminid"),
        F.lit("20200101").alias("create_time"),
    )
    store = n.select(
        F.col("n_nationkey").alias("id"),
        F.concat(F.col("n_name"), F.lit(" store")).alias("store_address"),
        F.concat(F.lit("B"), F.col("n_regionkey").cast("string")).alias("brand_name"),
        F.lit("bar").alias("sub_scence_name"),
    )
    base = s.select(
        k.alias("mid"),
        F.concat(F.lit("SN"), k.cast("string")).alias("serialnum"),
        F.when(k % 2 == 0, F.lit("on")).otherwise(F.lit("off")).alias("pay_switch"),
    )
    rate = lambda a, b, c: F.when(k % 3 == 0, F.lit(a)).when(k % 3 == 1, F.lit(b)).otherwise(F.lit(c))
    admin = s.select(
        k.alias("machine_num"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("s_name")).alias("machine_name"),
        (k % 3).cast("int").alias("package_num"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise(rate(0.3, 0.25, 0.2)).alias("inv_rate"),
        F.lit(0.05).alias("age_rate"),
        rate(0.1, 0.2, 0.3).alias("com_rate"),
        F.lit(0.5).alias("par_rate"),
    )
    local = machine_locations(machine_local(spark, d))
    return storemap, store, local, base, admin


def machine_star(spark, d):
    """Storemap ⨝ store ⨝ location ⨝ base ⨝ admin (all inner)."""
    storemap, store, local, base, admin = machine_tables(spark, d)
    j = (
        storemap.join(store, storemap.store_id == store.id)
        .join(local, storemap.machine_num == local.mid)
        .join(base.withColumnRenamed("mid", "_bmid"), storemap.machine_num == F.col("_bmid"))
        .join(admin.withColumnRenamed("machine_num", "_anum"), storemap.machine_num == F.col("_anum"))
    )
    return j.select(
        "mid", "province", "city", "address", "store_address", "brand_name", "sub_scence_name",
        "serialnum", "pay_switch", "machine_num", "machine_name", "package_num",
        "inv_rate", "age_rate", "com_rate", "par_rate", "adminid",
    )


def machine_geo(spark, d):
    """Geo-located machine places (the actual-location table)."""
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    located = F.col("s_suppkey") % 3 != 0  # the others were not located: NULL place, registered one is used
    return j.select(
        F.col("s_suppkey").alias("mid"),
        F.when(located, F.concat(F.lit("P"), F.col("n_regionkey").cast("string"))).alias("province"),
        F.when(located, F.col("n_name")).alias("city"),
        F.concat(F.lit("T"), (F.col("s_suppkey") % 4).cast("string")).alias("township"),
        F.col("s_name").alias("addressdetail"),
    )


def q_order_clean(spark, d):
    return clean(spark, d).select("id", "uid", "mid", "m_type", "pkg_id", "coin_price", "coin_cnt", "order_id", "order_type")


def q_machine_income(spark, d):
    return rev.revenue_groups(clean(spark, d))


def q_machine_refund(spark, d):
    return rev.refund_groups(clean(spark, d))


def q_machine_new_users(spark, d):
    return rev.new_users(users(spark, d))


def q_machine_star(spark, d):
    return machine_star(spark, d)


def q_machine_revenue_grain(spark, d):
    stats = rev.machine_statistics(clean(spark, d), users(spark, d), machine_star(spark, d), machine_geo(spark, d))
    return stats.select(
        "mid", "p_type", "pkg_id", "m_type", "machine_name", "adminid", "com_rate", "inv_rate",
        "province", "city", "township", "addressdetail",
        "total_user_cnt", "total_order_cnt", "total_revenue",
        "total_user_refund_cnt", "total_order_refund_cnt", "total_refund", "new_user_cnt",
    )


def fanout(spark, d):
    return rev.fanout_weights(clean(spark, d), users(spark, d), machine_star(spark, d), machine_geo(spark, d))


def q_machine_revenue_mid(spark, d):
    w = fanout(spark, d)
    return w.groupBy("mid", "m_type").agg(
        F.sum("n_rows").cast("long").alias("n_rows"),
        *[F.sum(c).cast("long").alias(c) for c in rev.SUM_COLS if c not in ("total_revenue", "total_refund")],
        F.sum("total_revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.sum("total_refund").cast("decimal(38,2)").alias("total_refund"),
    )


def q_revenue_ledger(spark, d):
    """The groups after years were added day by day of the ledger (a year is one here), one of them wrongly
    and then sent again, and one that was missing came late."""
    orders = clean(spark, d).withColumn("dt_data", F.substring("action_time", 1, 4))
    years = [str(y) for y in range(1992, 2003)]  # the table's years, and some without orders
    late, again = "1996", "1999"
    ledger = RevenueLedger(spark, scratch_path(spark, f"ledger-{uuid.uuid4().hex}"), key_types=("long", "int", "int"))
    # The orders of 1998 are sent a second time, as nobody's of ``again``; the join is read once.
    day = F.col("dt_data")
    own, wrong = F.struct(day, "uid"), F.struct(F.lit(again).alias("dt_data"), F.lit("nobody").alias("uid"))
    sent = F.when(day == F.lit("1998"), F.array(own, wrong)).when(day != F.lit(again), F.array(own))
    first = orders.select(*[c for c in orders.columns if c not in ("dt_data", "uid")], F.explode(sent).alias("_s")).select("*", "_s.*").drop("_s")
    ledger.replace_days(first, [y for y in years if y != late])
    ledger.replace_days(orders, [late, again])
    return ledger.totals()


STAT_ROW = ("mid", "p_type", "pkg_id", "m_type", "machine_name", "adminid", "com_rate", "inv_rate", "province", "city", "township", "addressdetail", *rev.SUM_COLS)
HALF = 10_000  # rows on each side of a machine's first row


def q_fanout_interval(spark, d):
    """The original's default rows around the first row of the machine that holds the middle row."""
    t = fanout_table(clean(spark, d), users(spark, d), machine_star(spark, d), machine_geo(spark, d))
    total = t.count()
    start = t.machine_starts(total // 2, total // 2 + 1).agg(F.min("start")).first()[0] or 0
    rows = t.rows(max(0, start - HALF), min(total, start + HALF))
    return rows.select("row_no", *STAT_ROW, F.lit(total).alias("total_rows"))


def q_province_count(spark, d):
    return rev.province_machine_count(machine_star(spark, d))


def q_province_revenue(spark, d):
    return rev.province_revenue(fanout(spark, d))


def q_operator_share(spark, d):
    return rev.operator_share(fanout(spark, d))


QUERIES = {
    "order_clean": q_order_clean,
    "machine_income": q_machine_income,
    "machine_refund": q_machine_refund,
    "revenue_ledger": q_revenue_ledger,
    "machine_new_users": q_machine_new_users,
    "machine_star": q_machine_star,
    "machine_revenue_grain": q_machine_revenue_grain,
    "machine_revenue_mid": q_machine_revenue_mid,
    "fanout_interval": q_fanout_interval,
    "province_count": q_province_count,
    "province_revenue": q_province_revenue,
    "operator_share": q_operator_share,
    "operator_share_distinct": lambda spark, d: rev.operator_share(fanout(spark, d), distinct_rates=True),  # D8
}

# ---------------------------------------------------------------- oracle SQL

OD = """raw AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS id, CAST(o.o_custkey AS VARCHAR) AS uid, l.l_suppkey AS mid,
         CAST(l.l_partkey % 3 AS INTEGER) AS p_type, CAST(l.l_orderkey % 9 AS INTEGER) AS m_type,
         l.l_linenumber AS pkg_id,
         CASE WHEN l.l_returnflag = 'R' THEN -CAST(l.l_extendedprice AS DECIMAL(10,2))
              ELSE CAST(l.l_extendedprice AS DECIMAL(10,2)) END AS amount,
         CAST(l.l_orderkey AS VARCHAR) AS order_id,
         CASE l.l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS order_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
od AS (
  SELECT id, uid, mid, p_type, m_type, pkg_id, CAST(abs(amount) AS DECIMAL(20,2)) AS coin_price, 1 AS coin_cnt,
         order_id, CASE WHEN order_type = 1 THEN 1 WHEN order_type = 2 THEN 3 ELSE 2 END AS order_type
  FROM raw),
rev AS (
  SELECT mid, pkg_id, m_type, count(DISTINCT uid) AS total_user_cnt, count(order_id) AS total_order_cnt,
         CAST(sum(coin_price * coin_cnt) AS DECIMAL(20,2)) AS total_revenue
  FROM od WHERE order_type = 1 GROUP BY mid, pkg_id, m_type),
ref AS (
  SELECT mid, pkg_id, m_type, count(DISTINCT uid) AS total_user_refund_cnt, count(order_id) AS total_order_refund_cnt,
         CAST(sum(coin_price * coin_cnt) AS DECIMAL(20,2)) AS total_refund
  FROM od WHERE order_type = 2 AND order_id IN (SELECT order_id FROM od WHERE order_type = 1)
  GROUP BY mid, pkg_id, m_type)"""

USERS = """usr AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uid, CAST(c_nationkey AS VARCHAR) AS reg_mid FROM customer),
nusr AS (SELECT reg_mid AS mid, count(DISTINCT uid) AS new_user_cnt FROM usr GROUP BY reg_mid)"""

MB = MACHINE_LOCAL + """,
loc AS (""" + MACHINE_UNION_SELECT + """),
mb AS (
  SELECT loc.mid, loc.province, loc.city, loc.address, nn.n_name || ' store' AS store_address,
         CASE WHEN s.s_suppkey % 13 = 0 THEN NULL ELSE s.s_name END AS machine_name,
         CASE WHEN s.s_suppkey % 10 = 9 THEN NULL ELSE CAST(s.s_suppkey % 4 AS INTEGER) END AS adminid,
         CASE WHEN s.s_suppkey % 11 = 0 THEN NULL
              ELSE CAST(CASE s.s_suppkey % 3 WHEN 0 THEN 0.3 WHEN 1 THEN 0.25 ELSE 0.2 END AS DOUBLE) END AS inv_rate,
         CAST(0.05 AS DOUBLE) AS age_rate,
         CAST(CASE s.s_suppkey % 3 WHEN 0 THEN 0.1 WHEN 1 THEN 0.2 ELSE 0.3 END AS DOUBLE) AS com_rate,
         CAST(0.5 AS DOUBLE) AS par_rate,
         'SN' || CAST(s.s_suppkey AS VARCHAR) AS serialnum
  FROM supplier s JOIN nation nn ON s.s_nationkey = nn.n_nationkey JOIN loc ON s.s_suppkey = loc.mid),
mbd AS (
  SELECT mid, province, city, address, machine_name, adminid,
         CAST(inv_rate AS DECIMAL(10,2)) AS inv_rate, CAST(age_rate AS DECIMAL(10,2)) AS age_rate,
         CAST(com_rate AS DECIMAL(10,2)) AS com_rate, CAST(par_rate AS DECIMAL(10,2)) AS par_rate
  FROM mb WHERE machine_name IS NOT NULL AND inv_rate IS NOT NULL),
ml AS (
  SELECT s.s_suppkey AS mid,
         CASE WHEN s.s_suppkey % 3 != 0 THEN 'P' || CAST(nn.n_regionkey AS VARCHAR) END AS province,
         CASE WHEN s.s_suppkey % 3 != 0 THEN nn.n_name END AS city,
         'T' || CAST(s.s_suppkey % 4 AS VARCHAR) AS township, s.s_name AS addressdetail
  FROM supplier s JOIN nation nn ON s.s_nationkey = nn.n_nationkey)"""

LABEL = """CASE {c} WHEN 0 THEN '投币' WHEN 1 THEN 'K金币' WHEN 2 THEN '银币' WHEN 3 THEN '音乐积分'
         WHEN 4 THEN '微信' WHEN 5 THEN '支付宝' WHEN 6 THEN '免费券' WHEN 7 THEN 'QQ' END"""

# The original statement, materialised: every order row of a machine joined
# to all revenue groups, refund groups, new users, machine rows and places.
FAN = f"""fan AS (
  SELECT od.mid, {LABEL.format(c='od.m_type')} AS m_type, mbd.adminid,
         mbd.com_rate, mbd.par_rate, mbd.inv_rate, mbd.age_rate,
         COALESCE(ml.province, mbd.province) AS province,
         rev.total_user_cnt, rev.total_order_cnt, rev.total_revenue,
         ref.total_user_refund_cnt, ref.total_order_refund_cnt, ref.total_refund, nusr.new_user_cnt
  FROM od LEFT JOIN rev ON od.mid = rev.mid
          LEFT JOIN ref ON od.mid = ref.mid
          LEFT JOIN nusr ON CAST(od.mid AS VARCHAR) = nusr.mid
          JOIN mbd ON od.mid = mbd.mid
          LEFT JOIN ml ON od.mid = ml.mid)"""

ALL = "WITH " + OD + ",\n" + USERS + ",\n" + MB + ",\n" + FAN

ORACLE = {
    "order_clean": "WITH " + OD + """
SELECT id, uid, mid, m_type, pkg_id, coin_price, coin_cnt, order_id, order_type FROM od""",
    "machine_income": "WITH " + OD + "\nSELECT * FROM rev",
    "machine_refund": "WITH " + OD + "\nSELECT * FROM ref",
    "revenue_ledger": "WITH " + OD + """,
grp AS (SELECT mid, pkg_id, m_type, count(*) AS n_od, count(*) FILTER (WHERE order_type = 1) AS n_pay FROM od GROUP BY mid, pkg_id, m_type)
SELECT g.mid, g.pkg_id, g.m_type, g.n_od, g.n_pay, rev.total_user_cnt, rev.total_order_cnt, rev.total_revenue,
       coalesce(ref.total_order_refund_cnt, 0) AS n_ref, ref.total_user_refund_cnt, ref.total_order_refund_cnt, ref.total_refund
FROM grp g LEFT JOIN rev USING (mid, pkg_id, m_type) LEFT JOIN ref USING (mid, pkg_id, m_type)""",
    "machine_new_users": "WITH " + USERS + "\nSELECT * FROM nusr",
    "machine_star": "WITH " + MB + """
SELECT mb.mid, mb.province, mb.city, mb.address, mb.store_address, 'B' || CAST(nn.n_regionkey AS VARCHAR) AS brand_name,
       'bar' AS sub_scence_name, mb.serialnum,
       CASE WHEN mb.mid % 2 = 0 THEN 'on' ELSE 'off' END AS pay_switch, mb.mid AS machine_num, mb.machine_name,
       CAST(mb.mid % 3 AS INTEGER) AS package_num, mb.inv_rate, mb.age_rate, mb.com_rate, mb.par_rate, mb.adminid
FROM mb JOIN supplier s ON mb.mid = s.s_suppkey JOIN nation nn ON s.s_nationkey = nn.n_nationkey""",
    "machine_revenue_grain": "WITH " + OD + ",\n" + USERS + ",\n" + MB + f"""
SELECT od.mid, od.p_type, od.pkg_id, {LABEL.format(c='od.m_type')} AS m_type, mbd.machine_name, mbd.adminid,
       mbd.com_rate, mbd.inv_rate,
       COALESCE(ml.province, mbd.province) AS province, COALESCE(ml.city, mbd.city) AS city,
       COALESCE(ml.township, mbd.address) AS township, ml.addressdetail,
       rev.total_user_cnt, rev.total_order_cnt, rev.total_revenue,
       ref.total_user_refund_cnt, ref.total_order_refund_cnt, ref.total_refund, nusr.new_user_cnt
FROM od LEFT JOIN rev ON od.mid = rev.mid AND od.pkg_id = rev.pkg_id AND od.m_type = rev.m_type
        LEFT JOIN ref ON od.mid = ref.mid AND od.pkg_id = ref.pkg_id AND od.m_type = ref.m_type
        LEFT JOIN nusr ON CAST(od.mid AS VARCHAR) = nusr.mid
        JOIN mbd ON od.mid = mbd.mid
        LEFT JOIN ml ON od.mid = ml.mid""",
    "machine_revenue_mid": ALL + """
SELECT mid, m_type, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(total_user_cnt) AS BIGINT) AS total_user_cnt, CAST(sum(total_order_cnt) AS BIGINT) AS total_order_cnt,
       CAST(sum(total_user_refund_cnt) AS BIGINT) AS total_user_refund_cnt,
       CAST(sum(total_order_refund_cnt) AS BIGINT) AS total_order_refund_cnt,
       CAST(sum(new_user_cnt) AS BIGINT) AS new_user_cnt,
       CAST(sum(total_revenue) AS DECIMAL(38,2)) AS total_revenue, CAST(sum(total_refund) AS DECIMAL(38,2)) AS total_refund
FROM fan GROUP BY mid, m_type""",
    # The whole product is counted per machine; the machines that meet the interval are written out and numbered.
    "fanout_interval": "WITH " + OD + ",\n" + USERS + ",\n" + MB + f""",
sizes AS (SELECT od.mid, count(*) AS size
          FROM od LEFT JOIN rev ON od.mid = rev.mid LEFT JOIN ref ON od.mid = ref.mid
               JOIN mbd ON od.mid = mbd.mid LEFT JOIN ml ON od.mid = ml.mid GROUP BY od.mid),
starts AS (SELECT mid, size, sum(size) OVER (ORDER BY mid) - size AS start, sum(size) OVER () AS total FROM sizes),
mid_start AS (SELECT start AS s, total FROM starts WHERE start <= total // 2 AND start + size > total // 2),
near AS (SELECT mid, start, s, mid_start.total FROM starts, mid_start WHERE start < s + {HALF} AND start + size > s - {HALF}),
numbered AS (
  SELECT near.start + row_number() OVER (PARTITION BY od.mid ORDER BY od.p_type NULLS FIRST, od.pkg_id NULLS FIRST, od.m_type NULLS FIRST,
           rev.pkg_id NULLS FIRST, rev.m_type NULLS FIRST, ref.pkg_id NULLS FIRST, ref.m_type NULLS FIRST) - 1 AS row_no,
         od.mid, od.p_type, od.pkg_id, {LABEL.format(c='od.m_type')} AS m_type, mbd.machine_name, mbd.adminid, mbd.com_rate, mbd.inv_rate,
         COALESCE(ml.province, mbd.province) AS province, COALESCE(ml.city, mbd.city) AS city,
         COALESCE(ml.township, mbd.address) AS township, ml.addressdetail,
         rev.total_user_cnt, rev.total_order_cnt, rev.total_revenue,
         ref.total_user_refund_cnt, ref.total_order_refund_cnt, ref.total_refund, nusr.new_user_cnt, near.s, near.total
  FROM near JOIN od ON near.mid = od.mid LEFT JOIN rev ON od.mid = rev.mid LEFT JOIN ref ON od.mid = ref.mid
       LEFT JOIN nusr ON CAST(od.mid AS VARCHAR) = nusr.mid JOIN mbd ON od.mid = mbd.mid LEFT JOIN ml ON od.mid = ml.mid)
SELECT CAST(row_no AS BIGINT) AS row_no, {", ".join(STAT_ROW)}, CAST(total AS BIGINT) AS total_rows
FROM numbered WHERE row_no >= s - {HALF} AND row_no < s + {HALF}""",
    "province_count": "WITH " + MB + """
SELECT province, count(mid) AS mac_cnt FROM mb GROUP BY province""",
    "province_revenue": ALL + """
SELECT province,
       CAST(sum(total_user_cnt) AS BIGINT) AS province_UserCnt, CAST(sum(new_user_cnt) AS BIGINT) AS province_RegUserCnt,
       CAST(sum(total_order_cnt) AS BIGINT) AS province_OrderCnt, CAST(sum(total_revenue) AS DECIMAL(38,2)) AS province_Revenue,
       CAST(sum(total_order_refund_cnt) AS BIGINT) AS province_RefundOrderCnt,
       CAST(sum(total_refund) AS DECIMAL(38,2)) AS province_Refund
FROM fan GROUP BY province""",
    "operator_share": ALL + """,
base AS (
  SELECT adminid, m_type, com_rate, par_rate, inv_rate, age_rate,
         sum(COALESCE(total_order_cnt, 0)) AS o, sum(COALESCE(total_order_refund_cnt, 0)) AS ro,
         sum(COALESCE(total_revenue, 0)) AS r, sum(COALESCE(total_refund, 0)) AS f, count(*) AS n
  FROM fan GROUP BY ALL),
tot AS (
  SELECT adminid, m_type AS pay_type,
         CAST(sum(o) AS BIGINT) AS total_order_count,
         CAST(sum(ro) AS BIGINT) AS total_refund_order_count,
         CAST(sum(r) AS DECIMAL(20,2)) AS total_revenue,
         CAST(sum(f) AS DECIMAL(20,2)) AS total_refund_revenue
  FROM base GROUP BY adminid, m_type),
shares AS (
  SELECT a.*,
         CAST(a.total_revenue * b.com_rate - a.total_refund_revenue * b.com_rate AS DECIMAL(20,2)) AS company,
         CAST(a.total_revenue * b.par_rate - a.total_refund_revenue * b.par_rate AS DECIMAL(20,2)) AS partner,
         CAST(a.total_revenue * b.inv_rate - a.total_refund_revenue * b.inv_rate AS DECIMAL(20,2)) AS investor,
         CAST(a.total_revenue * b.age_rate - a.total_refund_revenue * b.age_rate AS DECIMAL(20,2)) AS operator,
         b.n
  FROM tot a LEFT JOIN (SELECT adminid, com_rate, par_rate, inv_rate, age_rate, sum(n) AS n
                        FROM base GROUP BY ALL) b ON a.adminid = b.adminid)
SELECT adminid, pay_type, total_order_count, total_refund_order_count, total_revenue, total_refund_revenue,
       company, partner, investor, operator, CAST(sum(COALESCE(n, 1)) AS BIGINT) AS n_rows
FROM shares
GROUP BY ALL""",
}
ORACLE["operator_share_distinct"] = ORACLE["operator_share"].replace("CAST(sum(COALESCE(n, 1)) AS BIGINT) AS n_rows", "CAST(1 AS BIGINT) AS n_rows")
