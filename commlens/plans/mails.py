"""Mails made of the order tables, so that mail operators run over whole tables and have an answer in SQL.

An order is a mail from its customer to the suppliers of its lines; a line that was returned is a mail from its
supplier to the customer.  Names and addresses are rendered into header text here and are parsed by the operators; the
SQL never renders anything, so that equal results mean that parsing gives back what was rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    nation = F.regexp_replace(F.lower("n_name"), "[^a-z0-9]", "")
    return j.select(F.col("c_custkey").alias("key"), F.initcap(F.lower("c_mktsegment")).alias("first"), F.initcap(nation).alias("last"), F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@"), nation, F.lit(".example.com")).alias("email"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    nation = F.regexp_replace(F.lower("n_name"), "[^a-z0-9]", "")
    return j.select(F.col("s_suppkey").alias("key"), F.lit("Supplier").alias("first"), F.initcap(nation).alias("last"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit("@"), nation, F.lit(".example.org")).alias("email"))


#: The same people in SQL: key, name, email.
PEOPLE_SQL = """
cust AS (SELECT c_custkey AS key, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS first, regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') AS nation,
  'c' || c_custkey || '@' || regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') || '.example.com' AS email FROM customer JOIN nation ON c_nationkey = n_nationkey),
supp AS (SELECT s_suppkey AS key, 'Supplier' AS first, regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') AS nation,
  's' || s_suppkey || '@' || regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') || '.example.org' AS email FROM supplier JOIN nation ON s_nationkey = n_nationkey),
cnames AS (SELECT key, first || ' ' || upper(nation[1]) || nation[2:] AS name, email, nation FROM cust),
snames AS (SELECT key, first || ' ' || upper(nation[1]) || nation[2:] AS name, email, nation FROM supp)"""


def rendered(first: Column, last: Column, email: Column) -> Column:
    return F.concat(F.lit('"'), last, F.lit(", "), first, F.lit('" <'), F.initcap(email), F.lit(">"))


def order_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id (order), header text and body of each order that has lines."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    c, s = customers(spark, sf_dir), suppliers(spark, sf_dir)
    who = rendered(F.col("first"), F.col("last"), F.col("email"))  # once a person, not once a line
    lines = li.join(s.select("key", who.alias("who")), li.l_suppkey == F.col("key")).select("l_orderkey", "l_linenumber", "who")
    to = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "who"))).alias("to"))  # at most an order's lines
    named = lambda keep: F.array_join(F.transform(F.filter("to", keep), lambda x: x["who"]), "; ")
    m = o.join(c.select("key", who.alias("who")), o.o_custkey == F.col("key")).join(to, o.o_orderkey == to.l_orderkey)
    header = F.concat(
        F.lit("---------------------- Forwarded by A on B ----------\n> From: "), F.col("who"),
        F.lit("\n> Date: "), F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000 (UTC)\n> To: "), named(lambda x: x["l_linenumber"] <= 3),
        F.when(F.exists("to", lambda x: x["l_linenumber"] > 3), F.concat(F.lit("\n> Cc: "), named(lambda x: x["l_linenumber"] > 3))).otherwise(""),
        F.lit("\n> Subject: RE: order "), F.col("o_orderpriority"),
    )
    body = F.concat(F.lit("Dear all,\nplease see order "), F.col("o_orderkey").cast("string"), F.lit(".\nPhone: (555) 123-"), F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0"))
    return m.select(F.col("o_orderkey").alias("doc_id"), header.alias("header_text"), body.alias("body"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst, t, mail_id) without text: orders to each line's supplier, and returned lines back to the customer."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    j = li.join(o, li.l_orderkey == o.o_orderkey).select("o_orderkey", "o_custkey", "o_orderdate", "l_suppkey", "l_shipdate", "l_returnflag", "l_linenumber")
    c, s = F.concat(F.lit("c"), F.col("o_custkey").cast("string")), F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    id_ = F.col("o_orderkey") * 16 + F.col("l_linenumber")
    out = F.struct(c.alias("src"), s.alias("dst"), F.col("o_orderdate").alias("t"), id_.alias("mail_id"))
    back = F.struct(s.alias("src"), c.alias("dst"), F.col("l_shipdate").alias("t"), (id_ + 8).alias("mail_id"))
    return j.select(F.inline(F.when(F.col("l_returnflag") == "R", F.array(out, back)).otherwise(F.array(out))))  # one join for both


MESSAGES_SQL = """
msg AS (SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, o_orderdate AS t, o_orderkey * 16 + l_linenumber AS mail_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 's' || l_suppkey, 'c' || o_custkey, l_shipdate, o_orderkey * 16 + l_linenumber + 8 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')"""


def trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation-to-nation edges (src, dst, volume), the stronger half: customers' nations to suppliers' nations with an above-average number of lines."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    c, s, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(s, li.l_suppkey == s.s_suppkey)
    e = j.groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("volume"))
    name = lambda k, a: n.select(F.col("n_nationkey").alias(k), F.col("n_name").alias(a))
    e = e.join(name("c_nationkey", "src"), "c_nationkey").join(name("s_nationkey", "dst"), "s_nationkey").select("src", "dst", "volume")
    mean = e.agg(F.avg("volume").alias("mean"))
    return e.join(F.broadcast(mean), F.col("volume") > F.col("mean")).select("src", "dst", "volume")  # one row


TRADE_SQL = """
pairs AS (SELECT cn.n_name AS src, sn.n_name AS dst, count(*) AS volume FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY 1, 2),
e AS MATERIALIZED (SELECT * FROM pairs WHERE volume > (SELECT avg(volume) FROM pairs)),
nodes AS (SELECT src AS node FROM e UNION SELECT dst FROM e),
und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e WHERE src <> dst),
adj AS MATERIALIZED (SELECT a, b FROM und UNION ALL SELECT b, a FROM und)"""
