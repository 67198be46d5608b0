"""Readers and writers: gzip logs, per-type outputs, TSV text tables, exports."""

import gzip
import os


from playmart.sources import logs
from playmart.sources.sinks import export, jdbc_options
from playmart.sources.tables import conform, read_day_table, to_text_columns, write_day, write_text_table
from playmart.plans import schemas as S


def test_gzip_log_and_routed_outputs(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    with gzip.open(os.path.join(src, "a.log.gz"), "wt") as fh:
        fh.write('1&t&MINIK_CLIENT_SONG_PLAY_OPERATE_REQ&{"songid":"7"}&x&y\n2&t&LOGIN&{"u":1}&x&y\nshort&line\n')
    routed = logs.route_log(logs.split_log(logs.read_log(spark, src)))
    out = os.path.join(tmpdir_path, "out")
    logs.write_routed(logs.flatten_payloads(routed), out)
    folders = sorted(f for f in os.listdir(out) if f.startswith("event_type="))
    assert folders == ["event_type=LOGIN", "event_type=MINIK_CLIENT_SONG_PLAY_OPERATE_REQ"]
    play = spark.read.text(os.path.join(out, "event_type=MINIK_CLIENT_SONG_PLAY_OPERATE_REQ")).first().value
    assert play.split("\t")[0] == "7" and play.count("null") == 10
    assert spark.read.text(os.path.join(out, "event_type=LOGIN")).first().value == '{"u":1}'


def test_text_table_arrays(spark, tmpdir_path):
    df = spark.createDataFrame([("a", [2, 8]), ("b", [])], "k string, v array<int>")
    assert [tuple(r) for r in to_text_columns(df).collect()] == [("a", "2,8"), ("b", "")]
    write_text_table(df, os.path.join(tmpdir_path, "t"))
    back = spark.read.option("sep", "\t").csv(os.path.join(tmpdir_path, "t")).orderBy("_c0").collect()
    assert back[0]._c1 == "2,8"


def test_conform_by_name_and_day_write(spark, tmpdir_path):
    df = spark.createDataFrame([("9", "1", "x")], "order_id string, songid string, extra string")
    c = conform(df, S.PLAY_LOG)
    assert c.columns == S.PLAY_LOG.fieldNames() and c.first().songid == "1" and c.first().mid is None
    path = os.path.join(tmpdir_path, "ods")
    write_day(c, path, "20240101")
    write_day(c, path, "20240102")
    write_day(c.union(c), path, "20240101")  # replaces that day only
    back = read_day_table(spark, path, S.PLAY_LOG)
    got = {r.dt_data: r["count"] for r in back.groupBy("dt_data").count().collect()}
    assert got == {"20240101": 2, "20240102": 1}


def test_exports(spark, tmpdir_path):
    df = spark.createDataFrame([("p", 3, "20240101"), ("q", 4, "20240102")], "province string, mac_cnt long, dt_data string")
    target = os.path.join(tmpdir_path, "exp")
    export(df, target, mode="append")                     # all partitions
    export(df, target, mode="append", day="20240102")     # one day
    assert spark.read.parquet(target).count() == 3
    export(df, target, mode="overwrite", constant_day="20240105")
    rows = spark.read.parquet(target).collect()
    assert len(rows) == 2 and {r.dt_data for r in rows} == {"20240105"}
    opts = jdbc_options("jdbc:mysql://db:3306/marts", "t", user="u", password="p", driver="d")
    assert opts["dbtable"] == "t" and opts["useUnicode"] == "true" and opts["user"] == "u"
