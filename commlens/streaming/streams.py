"""Streaming forms of the bucketing and duplicate operators, over event-time streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def bucket_counts(stream: DataFrame, ts: str, by: list[str], width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts in windows of event time; rows later than ``late`` are left out, so state is bounded."""
    w = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("bucket"), *by, "n")


def without_repeats(stream: DataFrame, ts: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
