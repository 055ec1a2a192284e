"""Threads: splitting mails into linked parts, content ids, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commlens.functions.mime import decoded, parts


def decode_mails(df: DataFrame) -> DataFrame:
    """doc_id, path, header text, body, attachments of raw mails."""
    d = df.select("doc_id", "path", decoded("raw").alias("d"))
    return d.select("doc_id", "path", F.col("d.header").alias("header_text"), F.col("d.body").alias("body"), F.col("d.attachments").alias("attachments"))


def split_mails(df: DataFrame, connected: bool = False) -> DataFrame:
    """A row for each part of a mail: doc_id with ``_part_i_of_n`` if there are several, its neighbours' ids, header text, body.

    ``connected``: one row for each mail, with its own id and the parts as an array of such rows, in order.
    """
    rows = df.withColumn("parts", parts("header_text", "body")).withColumn("n", F.size("parts"))

    def part_id(i: Column) -> Column:
        several = F.concat("doc_id", F.lit("_part_"), i.cast("string"), F.lit("_of_"), F.col("n").cast("string"))
        return F.when((i < 0) | (i >= F.col("n")), F.lit(None)).when(F.col("n") == 1, F.col("doc_id")).otherwise(several)

    def fields(at: Column, part: Column) -> list[Column]:
        return [
            part_id(at).alias("doc_id"), "path", "attachments", part["header"].alias("header_text"), part["body"].alias("body"),
            part_id(at - 1).alias("successor"), part_id(at + 1).alias("predecessor"),
        ]

    if connected:
        return rows.select("doc_id", "path", F.transform("parts", lambda p, i: F.struct(*fields(i, p))).alias("parts"))
    return rows.select("doc_id", "path", "attachments", "n", F.posexplode("parts").alias("pos", "part")).select(*fields(F.col("pos"), F.col("part")))


def thread_links(df: DataFrame, thread: str, order: str, id_: Column) -> DataFrame:
    """Adds ``successor`` (the part before, newer) and ``predecessor`` (the part after, older) within a thread."""
    w = Window.partitionBy(thread).orderBy(order)
    return df.withColumn("successor", F.lag(id_).over(w)).withColumn("predecessor", F.lead(id_).over(w))


def content_id(*cols: Column) -> Column:
    """md5 of the parts, missing ones as empty strings, with a separator that they do not hold."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def longest_of_each(df: DataFrame, keys: list[Column], size: Column, tie: Column) -> DataFrame:
    """One row for each key: the one with the greatest size, ties to the smallest ``tie``.  Partial aggregation, no sort of a group."""
    named = [k.alias(f"__k{i}") for i, k in enumerate(keys)]
    best = df.select(*named, size.alias("__s"), tie.alias("__t"), F.struct("*").alias("__row"))
    got = best.groupBy(*[f"__k{i}" for i in range(len(keys))]).agg(F.min_by("__row", F.struct(-F.col("__s"), "__t")).alias("r"))
    return got.select("r.*")
