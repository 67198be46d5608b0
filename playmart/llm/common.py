"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playmart.session import checkpoint_dir

# The words of the contracts. Outside ASCII every byte belongs to a word.
_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz"
ALNUM_TABLE = bytes(b if b >= 0x80 else (b | 0x20 if 0x41 <= b <= 0x5A else (b if b in _ALNUM else 0x20)) for b in range(256))
# The characters that are not part of an alphanumeric word, for JVM regular expressions (after lower-casing).
NON_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (NULL for a NULL id)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(modulus)).cast("int")


def alnum_words(text: bytes) -> list[bytes]:
    """Words of ASCII digits, letters (lower-cased) and every non-ASCII character."""
    return text.translate(ALNUM_TABLE).split()


def space_words(text: bytes) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; NULL is the empty text."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(items: list[bytes], max_bytes: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``items`` of about ``max_bytes`` (at least one item each)."""
    lo = size = 0
    for i, t in enumerate(items):
        size += len(t)
        if size >= max_bytes:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(items):
        yield lo, len(items)


def bounded_sample(keys: DataFrame, group: str, n: int, order: list[str]) -> DataFrame:
    """The ``n`` rows of each group with the smallest hash of ``order`` (at least, of those
    under a hash threshold that about 2 * n rows of the group pass, so only few rows are ranked).

    The groups must be few: their sizes become one literal. The result has at most ``n``
    rows a group and the rank in the column ``__rank``.
    """
    sizes = {r[group]: r["count"] for r in keys.groupBy(group).count().collect()}
    if not sizes:
        return keys.withColumn("__rank", F.lit(0))
    limit = F.lit(0)
    for value, count in sizes.items():
        share = min(1.0, 2.0 * n / count) if count > 4 * n else 1.0
        limit = F.when(F.col(group).eqNullSafe(F.lit(value)), F.lit(int(share * (1 << 31)))).otherwise(limit)
    hashed = keys.withColumn("__hash", F.xxhash64(*order))
    few = hashed.where(F.shiftrightunsigned("__hash", 33) < limit)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.shiftrightunsigned("__hash", 33), "__hash", *order))
    return few.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__hash")


class Scratch:
    """A fresh folder of written tables under the shared ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/playmart-{name}-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return the written table: lineage ends here and a lost executor loses nothing."""
        self.n += 1
        path = f"{self.path}/t{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name = "_" + name
    return name
