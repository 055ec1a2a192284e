"""Who writes to whom: one row for each sender and recipient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prepared(mails: DataFrame, sender: Column, recipients: Column, sent: Column, id_: Column) -> DataFrame:
    """mail_id, sender, recipients, mail_timestamp (seconds; 0.0 where the date is missing)."""
    at = F.coalesce(F.unix_micros(sent.cast("timestamp")) / F.lit(1e6), F.lit(0.0))
    return mails.select(id_.alias("mail_id"), sender.alias("sender"), recipients.alias("recipients"), at.alias("mail_timestamp"))


def matched(messages: DataFrame, nodes: DataFrame | None = None, node: str = "node") -> DataFrame:
    """(src, dst, mail_id, t) for each recipient; with ``nodes``, only between existing nodes."""
    rows = messages.select(F.col("sender").alias("src"), F.explode("recipients").alias("dst"), "mail_id", F.col("mail_timestamp").alias("t"))
    if nodes is not None:
        own = nodes.select(F.col(node).alias("n")).distinct()
        rows = rows.join(own, F.col("src") == F.col("n"), "left_semi").join(own, F.col("dst") == F.col("n"), "left_semi")
    return rows


def edges(rows: DataFrame) -> DataFrame:
    """(src, dst, volume, mail_list, time_list), both lists in order of time, then id.

    The lists are the edge's data model and grow with one pair's mails; use ``weights`` where only counts are needed.
    """
    both = F.array_sort(F.collect_list(F.struct("t", "mail_id"))).alias("both")
    e = rows.groupBy("src", "dst").agg(F.count("*").alias("volume"), both)
    return e.select("src", "dst", "volume", F.transform("both", lambda x: x["mail_id"]).alias("mail_list"), F.transform("both", lambda x: x["t"]).alias("time_list"))


def weights(rows: DataFrame) -> DataFrame:
    return rows.groupBy("src", "dst").agg(F.count("*").alias("volume"))


def without_loops(e: DataFrame) -> DataFrame:
    return e.where("src <> dst")


def undirected(e: DataFrame) -> DataFrame:
    """Each pair once (a < b), without self loops."""
    return without_loops(e).select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()


def both_ways(e: DataFrame) -> DataFrame:
    """(a, b) and (b, a) of each undirected pair."""
    u = undirected(e)
    return u.union(u.select("b", "a"))


def nodes_of(e: DataFrame) -> DataFrame:
    return e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()
