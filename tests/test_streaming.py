import json
import os

from playmart.streaming.ingest import stream_play_log


def test_stream_ingest(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    for f in range(2):
        with open(os.path.join(src, f"part{f}.log"), "w") as fh:
            for i in range(5):
                payload = json.dumps({"songid": str(i), "play_time": f"2024013{f}120000"})
                fh.write(f"{i}&t&MINIK_CLIENT_SONG_PLAY_OPERATE_REQ&{payload}&x&y\n")
            fh.write("bad&line\n1&2&OTHER&{}&x&y\n")
    out = os.path.join(tmpdir_path, "ods")
    q = stream_play_log(spark, src, out, os.path.join(tmpdir_path, "ckpt"), "20240131")
    q.awaitTermination(120)
    df = spark.read.parquet(out)
    assert df.count() == 10
    assert [r.dt_data for r in df.select("dt_data").distinct().collect()] == [20240131]
    assert df.where("uid = 'null'").count() == 10
