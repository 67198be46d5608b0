"""Play-log ingest: delimited lines -> (event_type, payload) -> per-type outputs.

Text is read with ``spark.read.text`` (plain or ``.gz``; many files split the
work, one gzip is one task) and parsed with native expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions.text import json_field, null_text
from playmart.sources.archives import is_archive, read_archives

LOG_SEP = "&"
LOG_FIELDS = 6
TYPE_IDX = 2
PAYLOAD_IDX = 3

# The play event type and its payload fields, in output order.
PLAY_EVENT = "MINIK_CLIENT_SONG_PLAY_OPERATE_REQ"
PLAY_FIELDS = (
    "songid",
    "mid",
    "optrate_type",
    "uid",
    "consume_type",
    "play_time",
    "dur_time",
    "session_id",
    "songname",
    "pkg_id",
    "order_id",
)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines as a one-column frame ``value`` (gzip decoded by extension, tar archives member by member)."""
    if is_archive(path):
        return read_archives(spark, path).select("value")
    return spark.read.text(path)


def split_fields(line, sep: str = LOG_SEP) -> Column:
    """Split like Java ``String.split``: trailing empty fields are dropped."""
    line = F.col(line) if isinstance(line, str) else line
    esc = "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep
    return F.split(F.regexp_replace(line, f"(?:{esc})+$", ""), esc)


def split_log(lines: DataFrame, col: str = "value", sep: str = LOG_SEP, n_fields: int = LOG_FIELDS) -> DataFrame:
    """Keep lines with exactly ``n_fields`` fields; adds array column ``parts``."""
    return lines.select(split_fields(col, sep).alias("parts")).where(F.size("parts") == n_fields)


def route_log(parts: DataFrame, type_idx: int = TYPE_IDX, payload_idx: int = PAYLOAD_IDX) -> DataFrame:
    """(event_type, payload) from split lines."""
    return parts.select(
        F.get("parts", type_idx).alias("event_type"), F.get("parts", payload_idx).alias("payload")
    )


def play_fields(routed: DataFrame, fields=PLAY_FIELDS, mode: str = "permissive") -> DataFrame:
    """JSON payload -> one string column per field; the payload is parsed once.

    Of a key that occurs twice the last one counts, as in the original's parser.
    ``mode="permissive"``: invalid JSON gives NULL fields (the job goes on).
    ``mode="failfast"``: invalid JSON fails the job, as the original does.
    """
    if mode == "failfast":
        schema = ", ".join(f"{f} string" for f in fields)
        parsed = F.from_json(F.col("payload"), schema, {"mode": "FAILFAST"})
        return routed.select(*[parsed.getField(f).alias(f) for f in fields])
    return routed.select(F.json_tuple("payload", *fields).alias(*fields))


def play_record(payload, fields=PLAY_FIELDS) -> Column:
    """The play payload's fields tab-joined, missing ones written as ``null``."""
    return F.concat_ws("\t", *[null_text(json_field(payload, f)) for f in fields])


def join_record(columns) -> Column:
    """The record of fields that are columns already."""
    return F.concat_ws("\t", *[null_text(F.col(c)) for c in columns])


def flatten_payloads(routed: DataFrame, play_event: str = PLAY_EVENT, fields=PLAY_FIELDS) -> DataFrame:
    """(event_type, record): the play event becomes its fields tab-joined with
    missing ones written as ``null``; other events keep the raw payload."""
    names = [f"_f{i}" for i in range(len(fields))]
    parsed = routed.select("event_type", "payload", F.json_tuple("payload", *fields).alias(*names))
    record = join_record(names)
    return parsed.select(
        "event_type",
        F.when(F.col("event_type") == F.lit(play_event), record).otherwise(F.col("payload")).alias("record"),
    )


def write_routed(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One output folder per event type (``event_type=<key>``); the key itself
    is not written into the records."""
    records.write.mode(mode).partitionBy("event_type").text(path)


def ingest_play_log(spark: SparkSession, src: str, play_event: str = PLAY_EVENT) -> DataFrame:
    """Read -> filter -> route -> flatten; returns the records (not written)."""
    routed = route_log(split_log(read_log(spark, src)))
    return flatten_payloads(routed, play_event)
