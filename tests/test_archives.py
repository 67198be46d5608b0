"""Archives of logs against the lines that were put into them."""

import io
import os
import tarfile

import pytest

from playmart.sources import archives, logs


def archive(path, members, mode="w:gz"):
    with tarfile.open(path, mode) as tar:
        folder = tarfile.TarInfo("logs")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


LOGS = {
    "logs/a.log": b"1&2&T&{}&x&y\nsecond line\n",
    "logs/b.log": "é & 日本\r\nno end".encode(),
    "logs/" + "long" * 40 + ".log": b"".join(b"line %d\n" % i for i in range(25_000)),
    "logs/empty.log": b"",
    "logs/notes.txt": b"not a log\n",
}


def lines_of(members):
    return sorted(x for data in members.values() for x in data.decode().replace("\r\n", "\n").splitlines())


@pytest.mark.parametrize("name, mode", [("x.tar.gz", "w:gz"), ("x.tgz", "w:gz"), ("x.tar", "w"), ("x.tar.bz2", "w:bz2")])
def test_exactly_the_lines_of_all_members(spark, tmpdir_path, name, mode):
    path = os.path.join(tmpdir_path, name)
    archive(path, LOGS, mode)
    got = logs.read_log(spark, path)
    assert got.columns == ["value"] and sorted(r.value for r in got.collect()) == lines_of(LOGS)


def test_members_files_and_batches(spark, tmpdir_path):
    for k in range(3):
        archive(os.path.join(tmpdir_path, f"day{k}.tar.gz"), {n: d for i, (n, d) in enumerate(LOGS.items()) if i != k})
    df = archives.read_archives(spark, os.path.join(tmpdir_path, "*.tar.gz"), members="*.log")
    counts = {(os.path.basename(r.path), r.member): r["count"] for r in df.groupBy("path", "member").count().collect()}
    assert counts["day0.tar.gz", "logs/b.log"] == 2 and ("day0.tar.gz", "logs/a.log") not in counts
    assert sum(n for (_, m), n in counts.items() if m.startswith("logs/long")) == 50_000
    assert not any(m.endswith((".txt", "empty.log")) for _, m in counts)


def test_archive_goes_through_the_ingest(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "play.tar.gz")
    archive(path, {"p.log": b'0&1&MINIK_CLIENT_SONG_PLAY_OPERATE_REQ&{"songid":"7"}&x&y\nbad&line\n'})
    plays = logs.play_fields(logs.route_log(logs.split_log(logs.read_log(spark, path))))
    assert [r.songid for r in plays.collect()] == ["7"]


def test_damaged_archive_fails(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "bad.tar.gz")
    with open(path, "wb") as fh:
        fh.write(b"\x1f\x8bnot an archive")
    with pytest.raises(Exception):
        logs.read_log(spark, path).collect()
    assert not archives.is_archive("client.log.gz") and not archives.is_archive("folder/")
