"""The session that the engine expects: UTC, adaptive execution, Arrow."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def session(app: str = "commlens", master: str | None = None, **settings: str) -> SparkSession:
    """One session per process (a second call gets the first); keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).getOrCreate()
