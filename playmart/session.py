"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every playmart job wants. Partition counts are left to AQE: it
# coalesces small shuffles and splits skewed join partitions at runtime.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target size of coalesced partitions. On a shared cluster also set
    # spark.sql.adaptive.coalescePartitions.parallelismFirst=false so AQE sizes
    # partitions by bytes, not by core count (see README, "Running at scale").
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(
    app: str = "playmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the playmart defaults.

    ``master`` is only set when given, so on a cluster the submitter decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read here; a
    cluster without it is an error, since other hosts can't see a local folder.
    Only on a local master a fresh scratch folder is created for it.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect sessions have no SparkContext)
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        master = spark.conf.get("spark.master", "") if sc is None else sc.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all hosts of {master or 'the cluster'} share")
        current = tempfile.mkdtemp(prefix="playmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)
