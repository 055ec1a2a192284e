"""Persons from mails: sender and recipient records, merging by address and by name, lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commlens.functions.contacts import KINDS, aliases, emails, organisation, phones_of


def records(mails: DataFrame) -> DataFrame:
    """A row for the sender and one for each recipient of a mail: name, email, source (1 for senders), writes_to, signature."""
    to = F.transform("header.recipients", lambda r: r["email"])
    who = F.concat(
        F.array(F.struct(F.col("header.sender.name").alias("name"), F.col("header.sender.email").alias("email"), F.lit(True).alias("sends"))),
        F.transform("header.recipients", lambda r: F.struct(r["name"].alias("name"), r["email"].alias("email"), F.lit(False).alias("sends"))),
    )
    rows = mails.select(F.explode_outer(who).alias("w"), to.alias("to"))  # never empty; a plain explode may parse twice, once in a filter below it
    return rows.select("w.name", "w.email", F.when(F.col("w.sends"), F.col("to")).otherwise(F.array().cast("array<string>")).alias("writes_to"))


def best_name(names: Column) -> Column:
    """Of array<struct<name, n>>: among names whose first two parts have more than one letter the most frequent (then shorter, then first in order), else the longest."""
    def full(x: Column) -> Column:
        p = F.transform(F.split(x["name"], " +"), lambda w: F.replace(w, F.lit("."), F.lit("")))
        return (F.size(p) >= 2) & (F.length(F.get(p, F.lit(0))) > 1) & (F.length(F.get(p, F.lit(1))) > 1)

    whole = F.transform(F.filter(names, full), lambda x: F.struct((-x["n"]).alias("n"), F.length(x["name"]).alias("l"), x["name"].alias("name")))
    any_ = F.transform(names, lambda x: F.struct((-F.length(x["name"])).alias("l"), x["name"].alias("name")))
    return F.coalesce(F.array_min(whole)["name"], F.array_min(any_)["name"], F.lit(""))


def by_address(records_: DataFrame, providers: list[str]) -> DataFrame:
    """A person for each address: names with counts, best name, aliases, source_count, writes_to, organisation.

    Names are counted and recipients made distinct before they are gathered, so a busy address gathers its different
    partners, not its mails.
    """
    own = records_.where("email <> ''")
    counts = own.groupBy("email", "name").agg(F.count("*").alias("n"))
    names = counts.groupBy("email").agg(F.array_sort(F.collect_list(F.when(F.col("name") != "", F.struct("name", "n")))).alias("names"), F.sum("n").alias("source_count"))
    to = own.select("email", F.explode("writes_to").alias("to")).where("to <> ''").distinct().groupBy("email").agg(F.array_sort(F.collect_list("to")).alias("writes_to"))
    joined = names.join(to, "email", "left").withColumn("identifying_name", best_name(F.col("names")))
    return joined.select(
        F.array("email").alias("email_addresses"), "identifying_name", "names", "source_count",
        F.array_remove(F.transform("names", lambda x: x["name"]), F.col("identifying_name")).alias("aliases"),
        F.coalesce("writes_to", F.array().cast("array<string>")).alias("writes_to"), organisation(F.col("email"), providers).alias("organisation"),
    )


def contacts(mails: DataFrame) -> DataFrame:
    """A row for each mail's sender: sender_email_address, sender_name, signature, recipients, and what signature and recipients tell of the sender."""
    sig, email = F.col("signature"), F.col("sender_email_address")
    return mails.select(
        "signature", "sender_email_address", "sender_name", *[phones_of(sig, k).alias(f"phone_numbers_{k}") for k in KINDS],
        emails(sig).alias("email_addresses_from_signature"), aliases(sig, email).alias("sender_aliases"), F.array_distinct(F.transform("recipients", lambda r: r["email"])).alias("writes_to"),
    )


def merged_contacts(rows: DataFrame) -> DataFrame:
    """Of ``contacts``: a person for each address, with how often each name stands there, source_count and the union of every list.

    Values are counted by (address, field, value) before they are gathered, so a busy address gathers its different
    values, not its mails.  Lists are sorted; empty strings and nulls are no values; rows without an address go.
    """
    lists = [*[f"phone_numbers_{k}" for k in KINDS], "email_addresses_from_signature", "sender_aliases", "writes_to"]
    value = lambda field, c: F.struct(F.lit(field).alias("field"), c.alias("value"))

    def values(field: str) -> Column:
        return F.transform(F.coalesce(field, F.array().cast("array<string>")), lambda x: value(field, x))

    one = F.array(*[value(c, F.coalesce(c, F.lit(""))) for c in ("sender_name", "signature")])
    every = F.concat(one, *map(values, lists))
    own = rows.where("sender_email_address <> ''").select(F.col("sender_email_address").alias("email"), F.explode(every).alias("v"))
    counted = own.groupBy("email", "v.field", "v.value").agg(F.count("*").alias("n"))
    of = lambda field: F.when((F.col("field") == field) & (F.col("value") != ""), F.col("value"))
    union = lambda field: F.array_sort(F.collect_list(of(field)))
    names = F.map_from_entries(F.array_sort(F.collect_list(F.when(of("sender_name").isNotNull(), F.struct("value", "n")))))
    return counted.groupBy("email").agg(
        names.alias("identifying_names"), F.sum(F.when(F.col("field") == "sender_name", F.col("n"))).alias("source_count"), *[union(f).alias(f) for f in lists], union("signature").alias("signatures")
    ).select(
        F.array("email").alias("email_addresses"), "identifying_names", "source_count", *lists[:5], F.array().cast("array<string>").alias("aliases"),
        F.col("sender_aliases").alias("aliases_from_signature"), "writes_to", "signatures",
    )


def by_name(persons: DataFrame) -> DataFrame:
    """Persons of one identifying name merged; those without a name stay apart.  Lists are sorted unions, counts are sums."""
    key = F.when(F.col("identifying_name") != "", F.col("identifying_name"))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    named = persons.where(key.isNotNull()).groupBy("identifying_name").agg(
        union("email_addresses"), F.sum("source_count").alias("source_count"), union("aliases"), union("writes_to"), F.min("organisation").alias("organisation")
    )
    cols = ["email_addresses", "identifying_name", "source_count", "aliases", "writes_to", "organisation"]
    return named.select(*cols).unionByName(persons.where(key.isNull()).select(*cols))


def fallback_name(name: Column, aliases: Column, addresses: Column) -> Column:
    """The name, else the first alias, else the first address, else ''."""
    return F.coalesce(F.nullif(name, F.lit("")), F.nullif(F.get(aliases, F.lit(0)), F.lit("")), F.nullif(F.get(addresses, F.lit(0)), F.lit("")), F.lit(""))


def without_empties(c: Column) -> Column:
    return F.filter(c, lambda x: x != "")


def lookup(persons: DataFrame, priority: list[tuple[str, Column]], value: str, tie: str) -> DataFrame:
    """(kind, key, value): for each kind of key the value of the person that is first by ``tie``."""
    rows = None
    for i, (_, keys) in enumerate(priority):
        own = persons.select(F.lit(i).alias("kind"), F.explode(keys).alias("key"), F.col(value).alias("value"), F.col(tie).alias("tie")).where("key <> ''")
        rows = own if rows is None else rows.unionByName(own)
    return rows.groupBy("kind", "key").agg(F.min_by("value", "tie").alias("value"))


def resolved(df: DataFrame, table: DataFrame, keys: list[Column], as_: str, default: str | None = "") -> DataFrame:
    """Adds the value of the first key (in order) that the lookup knows.  Equi-joins: Spark broadcasts the lookup only while it is small, by its measured size."""
    out = df
    for i, k in enumerate(keys):
        own = table.where(F.col("kind") == i).select(F.col("key").alias(f"__key{i}"), F.col("value").alias(f"__v{i}"))
        out = out.withColumn("__k", k).join(own, F.col("__k") == F.col(f"__key{i}"), "left").drop("__k", f"__key{i}")
    return out.withColumn(as_, F.coalesce(*[F.col(f"__v{i}") for i in range(len(keys))], F.lit(default))).drop(*[f"__v{i}" for i in range(len(keys))])
