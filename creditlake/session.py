"""Settings for cluster sessions. Local tests and the bench set less."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and times are UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # AQE merges small shuffle partitions and splits skewed ones, so the initial
    # number may be generous; 128 MB of shuffled data per task stays in memory.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Plans are built from many small expressions; recording the caller of each
    # one costs more than building them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def cluster_builder(app: str) -> SparkSession.Builder:
    """A builder with :data:`SETTINGS`. The cluster itself names ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
