"""Lines of the files inside tar archives (plain, gzip, bzip2 or xz).

Spark's text reader undoes the compression of a ``.tar.gz`` but not the tar: member headers and padding end up
in the lines. Here Spark's binary reader hands each archive to a task, from any store that
Spark reads, and the task streams the members' lines out of it. An archive is one task and is held in
compressed form (2 GB at most, the limit of a binary value); lines leave in batches, whatever the members' sizes.
Many archives split the work.
"""

from __future__ import annotations

import fnmatch
import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SUFFIXES = (".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tar.xz")
LINES_PER_BATCH = 10_000
_SCHEMA = pa.schema([("path", pa.string()), ("member", pa.string()), ("value", pa.string())])


def is_archive(path: str) -> bool:
    return path.lower().endswith(SUFFIXES)


def member_lines(content: bytes, members: str) -> Iterator[tuple[str, str]]:
    """(member, line) of the regular files whose name matches; lines end at LF, CR LF or CR, as in Spark's text reader."""
    with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tar:
        for member in tar:
            if member.isfile() and fnmatch.fnmatch(member.name, members):
                with io.TextIOWrapper(tar.extractfile(member), encoding="utf-8", errors="replace") as text:
                    for line in text:
                        yield member.name, line.removesuffix("\n")


def read_archives(spark: SparkSession, path: str, members: str = "*") -> DataFrame:
    """(path, member, value): every line of the members whose name matches the pattern.

    ``path`` is an archive, a folder or a glob of archives. An empty member has no lines; a damaged archive fails its task.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names, values = [], []

                def rows() -> pa.RecordBatch:
                    out = pa.RecordBatch.from_arrays([pa.array([file] * len(names), pa.string()), pa.array(names), pa.array(values)], schema=_SCHEMA)
                    names.clear()
                    values.clear()
                    return out

                for name, line in member_lines(content.as_py(), members):
                    names.append(name)
                    values.append(line)
                    if len(names) >= LINES_PER_BATCH:
                        yield rows()
                if names:
                    yield rows()

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(lines, "path string, member string, value string")
