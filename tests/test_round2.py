"""What the findings of round 2 asked for: one parse a mail, one pass over the texts, aliases, slices."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from commlens.functions import contacts, header_rows, headers, mime
from commlens.operators import topics
from commlens.plans import registry

SF = "/root/testdata/sf0.001"
BITS = [
    "From:", "To:", "cc :", "BCC:", "Date:", "Sent:", "subject:", "x-odd-key:", "sender:", "Jane Doe", '"Doe, Jane [HR]"', "<jane.doe@acme.com>", "mailto:x@y.org", "SMTP:Q@Z.DE", "; ", ",", "\n", "\n> ",
    "\r\n", "\u0085", " ", "-----", "12/31/99 09:00 AM", "1.2.2003", "(Joe)", "[x", "<y", "'", '"', "/HOU/ACME@ACME", "*", "\t", "é", "İ", "Σ", "\x01", "\x02", "\x0b", "o'neil", "RE: ", "fw:", ":", "@", "a.b@", "3com",
]


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_header_batches(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(BITS) + rng.choice(["", " "]) for _ in range(rng.randrange(22)))) for i in range(500)] + [(-1, None), (-2, "")]
    df = spark.createDataFrame(rows, "i long, h string")
    for marks in (False, True):
        x = df.select(headers.header(F.col("h"), strip_marks=marks).alias("a"), headers.native_header(F.col("h"), strip_marks=marks).alias("b"), header_rows.sender_of(F.col("h")).alias("c"))
        assert x.where("NOT (a <=> b) OR NOT (c <=> a.sender)").count() == 0


@pytest.mark.parametrize("name", ["p12_recipients", "p29_writes_to", "a14_source_counts", "t1_split_mails", "t2_connected_threads"])
def test_parsed_once(spark, name):
    got = plan(registry.queries()[name](spark, SF))
    assert got.count("ArrowEvalPython") == (2 if name.startswith("t") else 1)


def test_aliases(spark):
    sig = F.lit("Regards\n\nOffice: 555-123-4567\ns56 peru\nél.ö-567\nx@y567")
    assert spark.range(1).select(contacts.aliases(sig, F.lit("s4567@peru.example.org")).alias("a")).first().a == []
    assert spark.range(1).select(contacts.aliases(F.lit("él.ö-567\ns45 peru"), F.lit("s4567@x.org")).alias("a")).first().a == ["él.ö-567", "s45 peru"]


def test_aliases_against_sql(spark):
    con = duckdb.connect()
    for t in ("supplier", "nation", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.1/{t}.parquet'")
    got = registry.queries()["p28_aliases"](spark, "/root/testdata/sf0.1").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(registry.oracle_sql()["p28_aliases"]).fetchall())


def test_slices():
    assert list(mime._slices([3, 3, 9, 1, 1], 6)) == [(0, 2), (2, 3), (3, 5)] and list(mime._slices([])) == []


def test_removed_terms_in_one_pass(spark):
    bags = spark.createDataFrame([(i, ["all", "few"] if i < 3 else ["all"]) for i in range(30)], "doc_id int, words array<string>").select("doc_id", "words")
    got = topics.removed_terms(bags, "doc_id", F.col("words"))
    assert [tuple(r) for r in got.collect()] == [("all", 30)] and plan(got).count("Generate explode") == 1


def test_terms_of_large_vocabularies(spark):
    bags = spark.createDataFrame([(i, [f"w{i % 50}x{j}" for j in range(40)]) for i in range(300)], "doc_id int, words array<string>")
    model = topics.train(bags, "words", k=2, iterations=2)
    got = topics.terms_of(model, 3)
    assert len(model.stages[0].vocabulary) == 2000 and len(plan(got)) < 2000 and [len(r.terms) for r in got.collect()] == [3, 3]
