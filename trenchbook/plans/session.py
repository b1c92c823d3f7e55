"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits the hot partitions of joins; its thresholds stay at Spark's defaults.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(name: str = "trenchbook", **settings: str) -> SparkSession:
    """A session with these settings; anything the caller gives comes first."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
