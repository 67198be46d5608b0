"""Intermediate tables under the shared checkpoint folder.

A written table ends the lineage of what follows: a lost executor costs the tasks of one
step, and every later reader sees the same rows. The folder is the scratch's own;
``close`` removes it once nothing reads it any more (the result is stored or collected).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from playmart.session import scratch_path


class Scratch:
    def __init__(self, spark: SparkSession, name: str = "scratch"):
        self.spark = spark
        self.path = scratch_path(spark, f"playmart-{name}-{uuid.uuid4().hex}")
        self.n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return the written table. The plan of ``df`` runs once."""
        self.n += 1
        path = f"{self.path}/t{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Remove the folder and all its tables."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def free_name(columns, base: str) -> str:
    """A column name that isn't taken (names are compared without case)."""
    taken = {c.lower() for c in columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = "_" + name
    return name
