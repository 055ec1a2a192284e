"""Side files: small tables that go to the rows of a written table without a shuffle of those rows.

A written table's rows have numbers (``monotonically_increasing_id``), whose upper bits are the part that was written.
A side table (part, idx, ...) is dealt out and written by part; the task that scans a part reads that part's side file
from the shared folder.  So texts stay where they are, however large they or the side table are; a task holds the side
rows of one part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from commlens.llm.common import positions, scratch, written


def open_uri(uri: str):
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri)
    return where, path


def side_files(df: DataFrame, name: str) -> str:
    """``df`` (part, idx, ...) as files by part; a folder."""
    folder = scratch(df.sparkSession, name)
    df.repartition("part").sortWithinPartitions("part", "idx").write.partitionBy("part").parquet(folder)
    return folder


def _load(folder: str, part: int) -> pa.Table | None:
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = open_uri(folder)
    at = f"{base}/part={part}"
    if store.get_file_info(at).type == fs.FileType.NotFound:
        return None
    files = [f for f in store.get_file_info(fs.FileSelector(at)) if f.path.endswith(".parquet")]
    return pa.concat_tables([pq.read_table(f.path, filesystem=store, partitioning=None) for f in files]) if files else None


class Side:
    """A side table's rows by row number, for the part that is being scanned."""

    def __init__(self, folder: str):
        self.folder, self.part, self.index, self.cols = folder, None, {}, {}

    def load(self, part: int) -> None:
        if part != self.part:
            t, self.part, self.index, self.cols = _load(self.folder, part), part, {}, {}
            if t is not None:
                t = t.sort_by("idx")
                self.cols = {c: t.column(c).to_numpy() for c in t.column_names}
                u, at = np.unique(self.cols["idx"], return_index=True)
                self.index = dict(zip(u.tolist(), zip(at.tolist(), np.append(at[1:], len(t)).tolist())))

    def rows(self, part: int, idx: int) -> tuple[int, int]:
        self.load(part)
        return self.index.get(idx, (0, 0))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written with row numbers: columns uid, c0, c1, ... (positions instead of names, so that no name can clash)."""
    return written(df.select(F.monotonically_increasing_id().alias("uid"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]), name)


def filtered(own: DataFrame, uids: DataFrame, like: DataFrame, keep: bool) -> DataFrame:
    """The rows of ``own = numbered(like)`` whose number is (``keep``) or is not among the different ``uids`` (uid); columns as in ``like``."""
    folder = side_files(uids.select(*positions()), "rows")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = Side(folder)
        for b in parts:
            at = b.column(0).to_numpy(zero_copy_only=False)
            mask = np.empty(len(at), dtype=bool)
            for part in np.unique(at >> 33).tolist():
                side.load(part)
                own_rows = at >> 33 == part
                mask[own_rows] = np.isin(at[own_rows] & (1 << 33) - 1, side.cols.get("idx", np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(b.columns[1:], names=b.schema.names[1:]).filter(pa.array(mask if keep else ~mask))

    schema = StructType([StructField(f"c{i}", f.dataType, True) for i, f in enumerate(like.schema)])
    return own.mapInArrow(run, schema).toDF(*like.columns)
