"""Sinks: JSON lines, Parquet, batches of flattened documents over any transport, graph tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _fewer(df: DataFrame, files: int | None) -> DataFrame:
    """At most so many output files, without a shuffle; None leaves them as they are."""
    return df if files is None else df.coalesce(files)


def json_lines(df: DataFrame, path: str, overwrite: bool = False, files: int | None = None) -> None:
    """One object a line; fails if the path exists unless told to overwrite."""
    _fewer(df, files).write.mode("overwrite" if overwrite else "errorifexists").json(path)


def parquet(df: DataFrame, path: str, overwrite: bool = False, by: tuple[str, ...] = (), files: int | None = None) -> None:
    _fewer(df, files).write.mode("overwrite" if overwrite else "errorifexists").partitionBy(*by).parquet(path)


def flat(df: DataFrame) -> DataFrame:
    """Nested structs become columns with dotted names; lists stay."""

    def walk(schema: StructType, at: str, name: str):
        for f in schema.fields:
            path, own = f"{at}`{f.name}`", f"{name}{f.name}"
            if isinstance(f.dataType, StructType):
                yield from walk(f.dataType, path + ".", own + ".")
            else:
                yield F.col(path).alias(own)

    return df.select(*walk(df.schema, "", ""))


def batches(rows: Iterator, size: int) -> Iterator[list[dict]]:
    held: list[dict] = []
    for r in rows:
        held.append(r.asDict(recursive=True))
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def upload(df: DataFrame, connect: Callable[[], Callable[[list[dict]], None]], rows_per_request: int = 1000) -> None:
    """Sends flattened rows in batches, every partition over its own connection; nothing is gathered on the driver.

    A retried task sends its rows again, so the receiver must take a row's id as its key.
    """

    def send(rows: Iterator) -> None:
        put = connect()
        for b in batches(rows, rows_per_request):
            put(b)

    flat(df).foreachPartition(send)


def graph(nodes: DataFrame, edges: DataFrame, path: str, mode: str = "both", overwrite: bool = False) -> None:
    """The node and edge tables; ``mode``: nodes, edges or both."""
    if mode not in ("nodes", "edges", "both"):
        raise ValueError(mode)
    if mode != "edges":
        parquet(nodes, f"{path}/nodes", overwrite)
    if mode != "nodes":
        parquet(edges, f"{path}/edges", overwrite)
