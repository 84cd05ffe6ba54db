"""Spark session with the settings the operators are tuned for.

Any session works; these are defaults for scripts and tests. A setting that the
caller (or the cluster's own configuration) has already made is left alone.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small shuffle partitions, splits skewed join
    # partitions by map output, turns joins on small sides into broadcasts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Lines may be long: bound Arrow batches by rows and by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def get_spark(app: str = "sentloom", master: str | None = None, **settings: str) -> SparkSession:
    """Build (or get) a session; ``settings`` use ``__`` for the dots of a key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
