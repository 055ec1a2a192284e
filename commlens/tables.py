"""Tables in the folder that driver and executors share, to cut lineage between rounds of an iterative operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of our own only where that is unset and driver and executors are one process.

    On a cluster an unset folder is an error, as a machine-local one would be lost to the other machines.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file:///tmp/commlens-" + spark.sparkContext.applicationId


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/commlens-{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again; the files go when the session's JVM ends."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
