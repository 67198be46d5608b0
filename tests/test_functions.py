"""Row-level golden tests: the edge rows of FIXTURES.md section 3."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playmart.functions import dates, scoring, text
from playmart.operators import relational as rel


def one(spark, values, expr_fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"s {typ}")
    return [r[0] for r in df.select(expr_fn(F.col("s"))).collect()]


def test_album(spark):
    got = one(spark, ["x《a》b\n《c》z", "》x《", "no mark", None], text.album)
    assert got == ["《a》b\n《c》", "", "", ""]


def test_singer(spark):
    two = '[{"name":"a","id":"1"},{"name":"b","id":"2"}]'
    vals = [two, '[{"id":"9"}]', "[]", "bad", '{"name":"a"}', None, '[{"name":"a"},5]']
    assert one(spark, vals, lambda c: text.singer(c, 1, "name")) == ["a", None, "", "", "", "", "a"]
    assert one(spark, vals, lambda c: text.singer(c, 2, "name")) == ["a", "", "", "", "", "", "a"]
    assert one(spark, vals, lambda c: text.singer(c, 2, "name", second_index=1))[0] == "b"
    assert one(spark, vals, lambda c: text.singer(c, 1, "id"))[0] == "1"


def test_post_date(spark):
    want = {
        "Aug 13, 2019 12:00:00 AM": "2019-08-13",
        "Aug 13, 2019": "2019-08-13",
        "Aug 13 2019": "2019-08-13",
        "13 August 2019": "2019-08-13",
        "13 Aug 2019 10:11:12": "2019-08-13",
        "Tue Aug 13 12:00:00 GMT 2019": "2019-08-13",
        "Tuesday, August 13, 2019 11:30 PM": "2019-08-13",
        "Tue Aug 13 23:00:00 EST 2019": "2019-08-14",
        "8/13/19": "2019-08-13",
        "8/13/2019 1:02:03": "2019-08-13",
        "2019/08/13 01:02": "2019-08-13",
        "2019/8/13": "2019-08-13",
        "Feb 30 2019": "2019-03-02",
        "2019-08-13": "1970-01-01",
        "2019-08-13 10:00:00": "1970-01-01",
        "Foo 13 2019": "1970-01-01",
        "13/13/2019": "1970-01-01",
        "Aug 2019": "1970-01-01",
        "x": "1970-01-01",
        "": "1970-01-01",
        None: "1970-01-01",
    }
    assert one(spark, list(want), lambda c: dates.post_date(c, century_start=1940)) == list(want.values())
    assert one(spark, ["8/13/39", "8/13/40", "x"], lambda c: dates.date_text(c, century_start=1940)) == ["2039-08-13", "1940-08-13", ""]


def test_company(spark):
    vals = ['{"name":"n","id":"1"}', '{"id":"1"}', "[1]", "bad", "{bad", "", None]
    assert one(spark, vals, text.company) == ["n", None] + ["自定义曲库"] * 5


def test_int_list(spark):
    vals = ["[2.0,8.0]", "[2.0,x,8]", "[2.0,]", "[,2]", "x[2]", "2,3", "[]", None, "[-1.9]"]
    assert one(spark, vals, text.int_list) == [[2, 8], [2], [2], [], [], [], [], [], [-1]]


def test_province_city(spark):
    vals = ["广东省深圳市南山", "广西壮族自治区南宁市x", "北京市朝阳", "无", "", None, "市a省b", "A自治区B省C市"]
    assert one(spark, vals, text.province) == ["广东", "广西壮族", "北京", "", "", "", "市a", "A"]
    assert one(spark, vals, text.city) == ["深圳", "南宁", "北京", "", "", "", "", "治区B省C"]


def test_default_time(spark):
    assert one(spark, ["null", None, "20200101000000"], text.default_time) == [
        "20150814000000", None, "20200101000000"]


def test_login_date(spark):
    got = one(spark, ["20220101120000", "bad", "", None], dates.login_date)
    assert got == [dt.date(2022, 1, 1), None, None, None]


def test_date_minus(spark):
    assert one(spark, ["20220819", "bad"], lambda c: dates.date_minus(c, 30)) == ["20220720", "19700101"]
    assert dates.shift_day("20220819", 30) == "20220720"
    assert dates.shift_day("bad", 30) == "19700101"


def test_order_recode(spark):
    assert one(spark, [1, 2, 3, None], rel.recode_order_type, "int") == [1, 3, 2, 2]
    assert one(spark, [-5, 5], rel.abs_amount, "int") == [5, 5]


def test_pay_label(spark):
    got = one(spark, list(range(9)) + [None], rel.pay_label, "int")
    assert got[:8] == list(rel.PAY_LABELS.values()) and got[8:] == [None, None]


def test_rsi_zero_and_null(spark):
    df = spark.createDataFrame([(0, 0, 0), (3, 0, None)], "n long, s long, t long")
    r = df.select(scoring.rsi_1("n", "s").alias("r1"), scoring.rsi_n("n", "s", "t").alias("r7")).collect()
    assert r[0]["r1"] == 0.0 and r[0]["r7"] == 0.0
    assert r[1]["r7"] is None


def test_share(spark):
    df = spark.createDataFrame([(100.0, 20.0, 0.1)], "a double, b double, r double")
    assert float(df.select(scoring.share("a", "b", "r")).first()[0]) == 8.0


def test_log_split(spark):
    from playmart.sources import logs

    lines = spark.createDataFrame([("a&b&T&{}&e&f",), ("a&b&c&d&e&",), ("a&b&c&d&e&f&g",), ("a&b&T&{}&e&f&",)], "value string")
    kept = logs.split_log(lines).collect()
    assert len(kept) == 2
    routed = logs.route_log(logs.split_log(lines)).first()
    assert (routed.event_type, routed.payload) == ("T", "{}")


def test_play_record(spark):
    from playmart.sources import logs

    df = spark.createDataFrame([('{"songid":"1"}',)], "payload string")
    rec = df.select(logs.play_record("payload")).first()[0]
    assert rec.split("\t") == ["1"] + ["null"] * 10


def test_play_fields_failfast(spark):
    from playmart.sources import logs

    df = spark.createDataFrame([("T", '{"songid":"1"}'), ("T", "{bad")], "event_type string, payload string")
    assert [r.songid for r in logs.play_fields(df).collect()] == ["1", None]
    with pytest.raises(Exception):
        logs.play_fields(df, mode="failfast").collect()


def test_common_dates_equal_the_general_form(spark):
    """Random texts made of date parts: where the quick patterns match, the general ones say the same."""
    import random

    rnd = random.Random(11)
    months = [m[:k].capitalize() for m in dates.MONTHS for k in (3, len(m))] + ["SEPT", "Ju", "Foo", "febr."]
    parts = [lambda: rnd.choice(months), lambda: str(rnd.randrange(0, 40)), lambda: str(rnd.choice([2019, 1999, 19, 40, 7, 2024])),
             lambda: rnd.choice(["Tue", "monday,", "Wed.", "xyz"]), lambda: f"{rnd.randrange(27)}:{rnd.randrange(62):02d}{rnd.choice(['', ':01', ' AM', 'pm'])}",
             lambda: rnd.choice(["GMT", "est", "UTC", "(note)"])]
    texts = []
    for _ in range(1500):
        m, d, y, w, t, z = (p() for p in parts)
        form = rnd.choice(["{m} {d}, {y}", "{d} {m} {y}", "{d}/{n}/{y}", "{y}/{n}/{d}", "{w} {m} {d} {t} {z} {y}", "{w}, {m} {d}, {y} {t}", "{m} {d} {t} {y} {z}", "{d} {m} {y} {t} {z}", "{n}/{d}/{y} {t}", "{t} {m} {d} {y}", "{m} {y}", " {m},{d}  {y} "])
        texts.append(form.format(m=m, d=d, y=y, w=w, t=t, z=z, n=rnd.randrange(15)))
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    rows = df.select("s", dates.free_date("s", 1940).alias("a"), dates._any_date("s", 1940).alias("b"), dates._common_date(F.col("s"), 1940).alias("c")).collect()
    assert all(r.a == r.b for r in rows), [tuple(r) for r in rows if r.a != r.b][:5]
    assert sum(r.c is not None for r in rows) > 400 and sum(r.b is not None and r.c is None for r in rows) > 20


def test_payload_is_parsed_once(spark):
    """json_tuple gives what get_json_object gives, but for keys that occur twice."""
    from playmart.sources import logs

    payloads = ['{"songid":"x","uid":1.50}', '{"uid":{"c":[1, 2.0]},"songid":null}', '{"songid":1e3,"uid":"\\u00e9\\n"}', "bad", '{"songid":1, bad', "[1]", '"s"', "", None,
                '{"SONGID":5}', '{"songid":12345678901234567890123,"uid":-0.0}', '{"songid":"","uid":[]}', "{'songid':'q','uid':2}", ' {"songid" : 7 } ', '{"uid":01,"songid":3}']
    df = spark.createDataFrame([(i, logs.PLAY_EVENT, p) for i, p in enumerate(payloads)], "i int, event_type string, payload string")
    got = logs.play_fields(df, ("songid", "uid")).collect()
    want = df.select(*[text.json_field("payload", f).alias(f) for f in ("songid", "uid")]).collect()
    assert got == want
    twice = spark.createDataFrame([('{"songid":1,"songid":2}',)], "payload string")
    assert logs.play_fields(twice, ("songid",)).first().songid == "2"
    p = logs.flatten_payloads(df)._jdf.queryExecution().executedPlan().toString()
    assert p.count("json_tuple") == 1 and "get_json_object" not in p
    records = logs.flatten_payloads(df).collect()
    assert records[0].record.startswith("x\tnull\tnull\t1.5\t") and len(records) == len(payloads)
