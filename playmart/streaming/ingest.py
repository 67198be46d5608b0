"""The play-log ingest (L1) as a Structured Streaming query.

New log files in ``src_dir`` are split, routed and flattened with the same
operators as the batch job and land in the same day partition of the ODS table: that
of the run date, with missing fields as the text ``null``. The Parquet file sink with
a checkpoint gives exactly-once output across restarts and lost executors.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playmart.functions.text import null_text
from playmart.sources import logs
from playmart.sources.tables import DAY_COL


def stream_play_log(
    spark: SparkSession,
    src_dir: str,
    table_path: str,
    checkpoint: str,
    run_date: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the ingest; ``available_now`` processes what is there and stops."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    routed = logs.route_log(logs.split_log(reader.load(src_dir)))
    plays = logs.play_fields(routed.where(F.col("event_type") == logs.PLAY_EVENT))
    out = plays.select(*[null_text(F.col(c)).alias(c) for c in plays.columns], F.lit(run_date).alias(DAY_COL))
    writer = (
        out.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy(DAY_COL)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(table_path)
