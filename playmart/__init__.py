"""playmart: PySpark-native marts for networks of pay-per-play song machines.

Layout:
  functions/  Column -> Column helpers (text cleansing, dates, scores)
  operators/  DataFrame -> DataFrame operators (features, ranking, revenue, users, geo)
  sources/    readers and writers (play logs, day-partitioned tables, exports)
  plans/      pipelines composed of operators, and the driver-table query registry
  streaming/  the play-log ingest as a Structured Streaming job
"""

from playmart.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
