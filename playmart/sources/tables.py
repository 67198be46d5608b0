"""Table scans, declared schemas and day-partitioned writes.

Tables are paths (Parquet by default). A day partition is the directory
``dt_data=yyyyMMdd``; its key is always read back as a STRING through an
explicit schema, never inferred (inference would turn it into an int).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_COL = "dt_data"


def table_path(base: str, name: str) -> str:
    """``base/name`` (the database of the original is a base folder here)."""
    return os.path.join(base, name)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Scan a table; with a schema, partition keys keep their declared type."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("sep", "\t").option("header", "false")
    return reader.load(path)


def read_day_table(spark: SparkSession, path: str, schema: T.StructType, day: str | None = None) -> DataFrame:
    """Scan a day-partitioned table; ``day`` filters on the string key, which
    Spark turns into a PartitionFilter (only that directory is listed/read)."""
    if DAY_COL not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(DAY_COL, T.StringType())])
    df = read_table(spark, path, schema)
    if day is not None:
        df = df.where(F.col(DAY_COL) == F.lit(day))
    return df


def conform(df: DataFrame, schema: T.StructType, strict: bool = False, optional=()) -> DataFrame:
    """Select the declared columns BY NAME and cast to the declared types.

    A missing column becomes a typed NULL, or is an error if ``strict`` and it
    isn't in ``optional``. A name that ``df`` has twice is an error. Explicit
    casts replace the by-position narrowing of the original inserts.
    """
    cols = []
    present = {c.lower(): c for c in df.columns}
    names = [c.lower() for c in df.columns]
    twice = sorted({f.name for f in schema.fields if names.count(f.name.lower()) > 1})
    if twice:
        raise ValueError(f"columns {twice} occur more than once")
    for field in schema.fields:
        src = present.get(field.name.lower())
        if src is None:
            if strict and field.name not in optional:
                raise ValueError(f"column {field.name} missing; have {df.columns}")
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.col(src).cast(field.dataType).alias(field.name))
    return df.select(*cols)


def write_day(df: DataFrame, path: str, day: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write ``df`` as day partition ``day`` of the table at ``path``.

    ``mode="overwrite"`` replaces only that day (dynamic partition overwrite set
    on the writer, so other days survive); re-running is idempotent.
    ``mode="append"`` adds rows to the day (re-runs duplicate them).
    """
    # A rebalance sizes the files (and merges the crumbs of many small tasks) without a fixed file count.
    out = df.drop(DAY_COL).withColumn(DAY_COL, F.lit(day)).hint("rebalance")
    (
        out.write.format(fmt)
        .mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY_COL)
        .save(path)
    )


def append_day(df: DataFrame, path: str, day: str, fmt: str = "parquet") -> None:
    """``insert into`` one day partition."""
    write_day(df, path, day, mode="append", fmt=fmt)


def write_days(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write a frame that already carries ``dt_data``; overwrite replaces only
    the days present in ``df``. Rows are rebalanced by day first, so a day's files
    come from a few tasks (a hot day is split by size) and not from every task."""
    (
        df.hint("rebalance", DAY_COL).write.format(fmt)
        .mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY_COL)
        .save(path)
    )


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """``insert overwrite`` of an un-partitioned snapshot table."""
    df.write.format(fmt).mode("overwrite").save(path)


def to_text_columns(df: DataFrame) -> DataFrame:
    """Render columns for a tab-separated text table: arrays joined by ``,``."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.array_join(F.col(f.name).cast("array<string>"), ",").alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*cols)


# Fixed value: how the text row format writes NULL.
TEXT_NULL = "\\N"


def write_text_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated text output (the original row format): arrays ``,``-joined, NULL
    as ``\\N``, nothing quoted. As in the original format, values can't hold tabs or line breaks."""
    cols = [F.coalesce(F.col(c), F.lit(TEXT_NULL)) for c in df.columns]
    to_text_columns(df).select(F.concat_ws("\t", *cols).alias("value")).write.mode(mode).text(path)


def read_text_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A tab-separated text table with its declared types; arrays are split at ``,``."""
    parts = spark.read.text(path).select(F.split("value", "\t").alias("p"))
    cols = []
    for i, f in enumerate(schema.fields):
        c = F.nullif(F.get("p", F.lit(i)), F.lit(TEXT_NULL))
        if isinstance(f.dataType, T.ArrayType):
            c = F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, ","))
        cols.append(c.cast(f.dataType).alias(f.name))
    return parts.select(*cols)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` in the session's catalog, with the declared schema, by day where it has one.

    With ``path`` the table's files are there, so the same table can also be read by path.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    days = f" PARTITIONED BY ({DAY_COL})" if DAY_COL in schema.fieldNames() else ""
    place = "" if path is None else " LOCATION '" + path.replace("'", "\\'") + "'"
    known = False
    if path is not None and days and not spark.catalog.tableExists(name):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        known = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{days}{place}")
    if known:  # days that were written by path before the table had a name
        spark.sql(f"MSCK REPAIR TABLE {name}")


def insert_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Rows into a table of the catalog, by the table's column order. ``overwrite`` replaces the whole table, or
    only the days that ``df`` holds if the table has days; ``append`` adds rows."""
    spark = df.sparkSession
    if mode == "overwrite" and DAY_COL in df.columns and spark.conf.get("spark.sql.sources.partitionOverwriteMode", "").lower() != "dynamic":
        raise ValueError("set spark.sql.sources.partitionOverwriteMode=dynamic: a static overwrite would drop the other days")
    df.select(*spark.table(name).columns).hint("rebalance").write.insertInto(name, overwrite=mode == "overwrite")
