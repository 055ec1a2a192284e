"""Readers, sinks, configuration, threads, persons, phrases, topics, streams, and the registered queries against their SQL."""

import glob
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from commlens import config, pipeline
from commlens.functions import headers
from commlens.operators import persons, phrases, threads, topics
from commlens.plans import registry
from commlens.sources import readers, sinks
from commlens.streaming import streams

SF = "/root/testdata/sf0.001"


def test_readers(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/sub/a.eml").write_text("From: a@x.com\nTo: b@x.com\nSubject: s\n\nHello\n")
    (tmp_path / "in/b.txt").write_text("no mail")
    (tmp_path / "in/bad.eml").write_text("Content-Type: multipart/mixed; boundary=zz\n\nno boundary")
    rows = readers.eml(spark, str(tmp_path / "in")).collect()
    assert len(rows) == 1 and rows[0].path.endswith("a.eml") and readers.eml(spark, str(tmp_path / "in"), keep_defective=True).count() == 2
    (tmp_path / "box").write_text("From a Mon\nFrom: a\n\none\n\nFrom b Tue\nFrom: b\n\ntwo\n")
    assert sorted(r.raw.split("\n")[0] for r in readers.mbox(spark, str(tmp_path / "box")).collect()) == ["From: a", "From: b"]
    (tmp_path / "lab/spam").mkdir(parents=True)
    (tmp_path / "lab/spam/1").write_text("x")
    assert readers.labelled(spark, str(tmp_path / "lab")).first().label == "spam"
    (tmp_path / "cats").mkdir()
    (tmp_path / "cats/1.txt").write_text("x")
    (tmp_path / "cats/1.cats").write_text("1,2,3\n4,1,1\n")
    assert sorted(r.category for r in readers.categorised(spark, str(tmp_path / "cats")).collect()) == ["1", "4"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, (2, ("x",)), [1])], "a int, b struct<c:int,d:struct<e:string>>, f array<int>")
    assert sinks.flat(df).columns == ["a", "b.c", "b.d.e", "f"]
    sinks.json_lines(df, str(tmp_path / "j"))
    with pytest.raises(Exception):
        sinks.json_lines(df, str(tmp_path / "j"))
    sinks.json_lines(df, str(tmp_path / "j"), overwrite=True)
    assert [len(b) for b in sinks.batches(iter(spark.range(7).collect()), 3)] == [3, 3, 1]
    out = str(tmp_path / "sent")

    def connect():
        def put(rows):
            with open(out, "a") as f:
                f.write(f"{len(rows)}\n")

        return put

    sinks.upload(spark.range(5).coalesce(1), connect, 2)
    assert open(out).read().split() == ["2", "2", "1"]
    sinks.graph(df, df, str(tmp_path / "g"), "nodes")
    assert glob.glob(str(tmp_path / "g/nodes/*.parquet")) and not glob.glob(str(tmp_path / "g/edges"))


def test_config_and_pipeline(spark, tmp_path):
    (tmp_path / "c.ini").write_text("[commlens]\ntopics = 7\noverwrite = false\nphrase_lengths = 1, 2\nbucket = ${other:unit}\n[other]\nunit = day\n")
    c = config.load(str(tmp_path / "c.ini"), df_min=9)
    assert (c.topics, c.overwrite, c.phrase_lengths, c.bucket, c.df_min) == (7, False, [1, 2], "day", 9)
    lines = dict(x.split("=", 1) for x in config.exports(c).splitlines())
    assert lines["COMMLENS_TOPICS"] == '"7"' and lines["COMMLENS_PHRASE_LENGTHS"] == '"1,2"' and lines["COMMLENS_OVERWRITE"] == '"False"'
    assert config.exports(config.replace(c, bucket='a"$b')).count('a\\"\\$b') == 1
    sinks.json_lines(spark.range(100).repartition(5), str(tmp_path / "few"), files=2)
    assert len(list((tmp_path / "few").glob("part-*"))) == 2 and spark.read.json(str(tmp_path / "few")).count() == 100
    p = pipeline.Pipeline(lambda: spark.range(5), [lambda d: d.where("id > 1"), lambda d: d.withColumn("x", F.col("id") * 2)], lambda d: d.count())
    assert p.run() == 3
    done = {}
    pipeline.staged([("a", lambda d: d.where("id > 0")), ("b", lambda d: d.where("id > 1"))], done.__getitem__, lambda d, n: done.__setitem__(n, d), first=spark.range(4))
    assert done["b"].count() == 2


def test_threads_and_persons(spark):
    raw = "From: Jane Doe <jane.doe@acme.com>\nTo: Bob Ray <bob@acme.com>\nDate: 1 Jan 2001 10:00:00 +0000\nSubject: s\n\nHi\n\n-----Original Message-----\nFrom: Bob Ray <bob@acme.com>\nSent: x\nTo: Jane <jane.doe@acme.com>\nSubject: t\n\nYo\n"
    parts = threads.split_mails(threads.decode_mails(spark.createDataFrame([("m", "p", raw)], "doc_id string, path string, raw string")))
    rows = {r.doc_id: r for r in parts.collect()}
    assert set(rows) == {"m_part_0_of_2", "m_part_1_of_2"} and rows["m_part_0_of_2"].predecessor == "m_part_1_of_2" and rows["m_part_1_of_2"].successor == "m_part_0_of_2"
    mails = parts.select("doc_id", headers.header(F.col("header_text")).alias("header"))
    by = {r.email_addresses[0]: r for r in persons.by_address(persons.records(mails), ["gmail"]).collect()}
    jane = by["jane.doe@acme.com"]
    assert (jane.identifying_name, jane.source_count, jane.aliases, jane.writes_to, jane.organisation) == ("Jane Doe", 2, ["Jane"], ["bob@acme.com"], "Acme")
    again = threads.longest_of_each(parts.union(parts), [F.col("doc_id")], F.length("body"), F.col("body"))
    assert again.count() == 2
    merged = persons.by_name(persons.by_address(persons.records(mails), [])).collect()
    assert sorted(r.identifying_name for r in merged) == ["Bob Ray", "Jane Doe"]


def test_connected_threads(spark):
    raw = "From: A <a@b.com>\nSubject: s\n\nHi\n\n-----Original Message-----\nFrom: C <c@b.com>\nSubject: t\n\nYo\n"
    mails = threads.decode_mails(spark.createDataFrame([("m", "p", raw), ("n", "p", None)], "doc_id string, path string, raw string"))
    whole = {r.doc_id: r.parts for r in threads.split_mails(mails, connected=True).collect()}
    flat = threads.split_mails(mails).collect()
    assert [(p.doc_id, p.body, p.successor, p.predecessor) for k in ("m", "n") for p in whole[k]] == [(r.doc_id, r.body, r.successor, r.predecessor) for r in sorted(flat, key=lambda r: r.doc_id)]


def test_merged_contacts(spark):
    kind = "signature string, sender_email_address string, sender_name string, recipients array<struct<name: string, email: string>>"
    rows = [
        ("Jane Doe\nPh: 713-555-1234\nFax: 7135550000\nme@home.example", "jane.doe@x.com", "Jane Doe", [("B", "b@x.com"), ("B", "b@x.com")]),
        ("Jane\nPh: 713-555-1234\nCell: 555 - 123 - 4567", "jane.doe@x.com", "Jane D.", [("C", "c@x.com")]), (None, "jane.doe@x.com", None, None), ("x", "", "Nobody", []), ("x", None, "Nobody", []),
    ]
    got = persons.merged_contacts(persons.contacts(spark.createDataFrame(rows, kind))).collect()
    assert len(got) == 1
    p = got[0]
    assert p.email_addresses == ["jane.doe@x.com"] and p.identifying_names == {"Jane Doe": 1, "Jane D.": 1} and p.source_count == 3
    assert (p.phone_numbers_office, p.phone_numbers_cell, p.phone_numbers_fax, p.phone_numbers_home) == (["713-555-1234"], ["555 - 123 - 4567"], ["7135550000"], [])
    assert p.email_addresses_from_signature == ["me@home.example"] and p.writes_to == ["b@x.com", "c@x.com"] and len(p.signatures) == 2
    assert p.aliases_from_signature == ["Jane", "Jane Doe"] and p.aliases == []


def test_feature_columns(spark):
    from commlens.functions import features as ft

    one = lambda c: spark.range(1).select(c.alias("c")).first().c
    lit = F.lit
    assert [one(ft.flag(lit(x), "is_noreply")) for x in ("no-reply@a.b", "noreply@a.b", "newsletter@a.b", "info@a.b", "notify@a.b", "jane@a.b", None)] == [1, 1, 1, 1, 1, 0, 0]
    assert [one(ft.flag(lit(x), "has_unsubscribe")) for x in ("Unsubscribe here", "your e-mail preferences", "email preferences", "none")] == [1, 1, 1, 0]
    assert [one(ft.flag(lit(x), "has_html_tag")) for x in ("<b>", "<br/>", '<a href="x">', "a < b", "<br />")] == [1, 0, 1, 0, 0]
    assert [one(ft.flag(lit(x), "is_reply")) for x in ("RE: a", "Re:a")] == [1, 0] and one(ft.flag(lit("FWD: a"), "is_forward")) == 1 and [one(ft.flag(lit(x), "has_reply_to")) for x in ("a@b", "")] == [1, 0]
    assert one(ft.flag(lit("p #x {a: b}"), "has_css")) == 1 and one(ft.flag(lit(". " * 60_000), "has_css")) == 0
    names = lit("Jane Doe;Bob Ray")
    assert one(ft.names_in_salutation(names, lit("Hi Jane\nBob"), 0)) == 0.5 and one(ft.names_in_salutation(names, lit("Doe and Ray"), 1)) == 1.0
    assert one(ft.names_in_salutation(lit("Jane"), lit("Jane"), 1)) == 0.0 and one(ft.names_in_salutation(names, lit(None).cast("string"), 0)) == 0.0
    assert one(ft.name_in_body(lit("Jane Doe"), lit("yours, Doe"), 1)) == 1 and one(ft.name_in_body(lit(""), lit("x"), 0)) == 0
    amount = ft.recipients_amount(lit("a@b, c@d"), lit(""))
    assert one(amount["recipients_amount"]) == 2 and one(amount["recipients_is_single"]) is False
    df = spark.createDataFrame([("b", True), ("a", False), (None, None)], "k string, f boolean")
    assert sorted(ft.label_encode(df, "k").select("k").toPandas().k.dropna().tolist()) == [0, 1] and ft.one_hot(df, "k").columns == ["f", "k_a", "k_b"]
    assert [r.f for r in ft.as_integers(df, ["f"]).collect()] == [1, 0, None] and ft.drop_prefixed(df, ["k"]).columns == ["f"] and ft.drop_containing(df, ["f"]).columns == ["k"]
    assert ft.label_encode(df.limit(0), "k").count() == 0 and ft.one_hot(df.limit(0), "k").columns == ["f"]


def test_nearest(spark):
    """Blocks of queries against brute force, with copies, ties and nulls."""
    from commlens.operators import models

    rng = random.Random(5)
    vectors = [[rng.randrange(4) / 2 for _ in range(3)] for _ in range(80)] + [[0.5, 0.5, 0.5]] * 9
    rows = [(i, v) for i, v in enumerate(vectors)] + [(None, [0.0, 0.0, 0.0]), (500, None)]
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(3)
    want = []
    for i in range(0, len(vectors), 7):
        d = sorted((round(sum((x - y) ** 2 for x, y in zip(vectors[i], w)) ** 0.5, 6), j) for j, w in enumerate(vectors) if j != i)
        want += [(i, j, r + 1, x) for r, (x, j) in enumerate(d[:4])]
    for block in (5, 4096):
        got = models.nearest(df.where("id % 7 = 0 OR id IS NULL"), df, "id", "v", 4, block)
        assert sorted((r.id, r.neighbour, r["rank"], r.distance) for r in got.collect()) == sorted(want)
    assert models.nearest(df.limit(0), df, "id", "v", 4).count() == 0


def test_windows_covering():
    rng = random.Random(1)
    for _ in range(500):
        n, width = rng.randrange(1, 12), rng.randrange(1, 8)
        a, b = sorted(rng.choices(range(n), k=2))
        w = min(n, width)
        want = sum(1 for s in range(min(n - w + 1, n - 1) + 1) if s <= a and b <= s + w)
        assert phrases.windows_covering(a, b, n, width) == want


def test_phrases_and_topics(spark):
    text = "The central server room floods whenever the central server room pump fails. " * 5
    got = phrases.keyphrases(text)
    assert got and got[0][1] >= got[-1][1] and any("server room" in p for p, _ in got)
    assert phrases.keyphrases("") == [] and phrases.keyphrases(None) == []
    df = spark.createDataFrame([(1, text), (2, None)], "id int, text string")
    assert phrases.chunk_phrases(df, "id", "text", chunk=100).select("chunk").distinct().count() > 1
    t = phrases.tagged(df, [("central server", 1.0), ("nothing", 0.5)], F.col("text")).orderBy("id").collect()
    assert [k.phrase for k in t[0].keyphrases] == ["central server"]
    import numpy as np

    assert topics.chain(np.array([[1, 0, 0], [0, 0, 1], [0.9, 0.1, 0]]), 0) == [0, 2, 1]
    bags = spark.createDataFrame([(i, ["apple", "pear", "plum"] if i % 2 else ["car", "bus", "tram"]) for i in range(20)], "doc_id int, words array<string>")
    model = topics.train(bags, "words", k=2, iterations=15, most=0.9)
    rows = topics.topic_rows(model, bags, "doc_id").collect()
    assert {r.doc_id for r in rows} == set(range(20)) and all(0.02 <= r.topic_conf <= 1 and len(r.terms) == 6 for r in rows)
    assert {r.topic_rank for r in rows} <= {0, 1}
    assert len(topics.shown(model, 2)) == 2 and all(x.startswith("topic # ") and x.count(",") == 1 for x in topics.shown(model, 2))


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (1, "2024-01-01 10:00:01"), (2, "2024-01-02 10:00:00")], "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    s = streams.without_repeats(streams.source(spark, str(tmp_path / "in"), rows.schema), "ts", ["id"])
    s.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


#: Queries whose plans are cheap enough to run here one by one; the driver compares all.
CHECKED = ["p14_clamped_dates", "p26_phones", "p27_emails", "p19_without_headers", "p20_strict", "x2_x7_text_features", "x11_x26_time_features", "a1_longest_of_each", "a2_content_id", "w1_thread_links", "w2_part_ids", "p37_y11_line_blocks", "p38_zones", "s11_a11_edges", "j3_responses", "a9_frequent_terms", "a8_buckets_month", "m5_hellinger", "m7_nearest", "x8_names", "x9_flags", "x14_x15_y4_encodings", "x19_x28_x29_recipients", "x20_is_thread", "p1_p6_decoded", "s2_s5_json_lines"]


@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {f.split('/')[-1][:-8]} AS SELECT * FROM '{f}'")
    got, want = registry.queries()[name](spark, SF).toPandas(), con.execute(registry.oracle_sql()[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(str, got[cols].round(6).astype(object).where(got[cols].notna(), None).values.tolist())) == sorted(map(str, want[cols].round(6).astype(object).where(want[cols].notna(), None).values.tolist()))


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.entry(spark).columns) == 5
