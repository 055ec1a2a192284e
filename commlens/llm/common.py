"""What the operators of this subpackage share: the shared folder, written tables, narrow input columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The tokenizer file that the registered queries take; operators get any path as a parameter.
TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER_FILE))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    One of our own only where that is unset and driver and executors are one process (``local[...]``: tests); on a
    cluster an unset folder is an error, as a machine-local one would be lost to the other machines.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.partition("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file:///tmp/commlens-" + spark.sparkContext.applicationId


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/commlens-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, folder: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a table that ``written`` gave and that nothing will read again."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        deleted(df.sparkSession, folder)


def positions(uid: str = "uid") -> tuple[Column, Column]:
    """(part, idx) of a row number made by ``monotonically_increasing_id``: the task that wrote the row, and its place there."""
    return F.shiftright(uid, 33).alias("part"), F.col(uid).bitwiseAND((1 << 33) - 1).alias("idx")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(c: str | Column) -> Column:
    """A text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("binary")


def slices(parts: Iterator[pa.RecordBatch], column: int, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``max_bytes`` of a text column each (a longer text is a slice of its own), so that a worker holds little at a time."""
    for b in parts:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        cut = np.flatnonzero(np.diff(size // max_bytes, prepend=0)) if len(size) else size
        for a, z in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows], strict=True):
            if z > a or not b.num_rows:
                yield b.slice(a, z - a)
