"""What findings F6 to F23 of round 2 asked for: the same results by steps that grow with the input."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from commlens.functions import cleaning
from commlens.operators import edges, graph, phrases, topics
from commlens.plans import mails as plans
from commlens.plans import registry
from commlens.tables import shared_path

def _documents(spark, rows) -> str:
    folder = shared_path(spark, "documents")
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(folder + "/documents.parquet")
    return folder


WORDS = ["re", "be-am", "stone", "river", "the", "o'neil", "12", "ΑΣ", "İx", "Straße", "a", "of", "to_do", "zed", "Él", "go", "is"]


def test_candidates_against_all_phrases():
    """Phrases by sorted places are those that listing every phrase gives."""
    rng = random.Random(5)
    for n in [0, 1, 2, 5, 20, 60, 300, 1500, 2500] * 3:
        text = " ".join(rng.choice(WORDS[: rng.randrange(3, len(WORDS))]) + rng.choice(["", "", ".", "'s"]) + (str(i) if rng.random() < 0.2 else "") for i in range(n))
        tokens = [t.lower() for t in phrases.TOKEN.findall(text)]
        assert phrases._tokens(text) == tokens
        for lengths, most in (((2, 3, 4, 5, 6), 300), ((1, 3), 7), ((4,), 50)):
            places, least = defaultdict(list), min(len(tokens) / 1000, 4)
            for size in lengths:
                for i in range(len(tokens) - size + 1):
                    t = tokens[i : i + size]
                    if len(" ".join(t)) > 6 and not any(x in phrases._STOP or x.isdigit() for x in t):
                        places[" ".join(t)].append(i)
            want = sorted(((p, at) for p, at in places.items() if len(at) >= least), key=lambda x: (-len(x[1]), x[0]))[:most]
            got = phrases._candidates(tokens, lengths, least, most)
            assert [(" ".join(tokens[i : i + size]), sorted(at)) for i, size, at in got] == want


def test_replies_without_their_pairs(spark):
    """Running counts by spans give what listing all pairs gives, also at equal times, limits, ends of spans and for loops."""
    rng = random.Random(9)
    day, rows = 86_400_000_000, []
    for i in range(900):
        src, dst = rng.choice("abcé"), rng.choice("abcdé")
        at = rng.choice([rng.randrange(0, 260) * day, rng.randrange(0, 30 * day), 64 * day * rng.randrange(-1, 4) + rng.randrange(-6, 6) * day // 2])
        rows.append((src if i % 50 else None, dst if i % 61 else None, at if i % 40 else None))
    mails = spark.createDataFrame(rows, "src string, dst string, us long").select("src", "dst", F.timestamp_micros("us").alias("t")).cache()
    pairs = graph.responses(mails)
    want = pairs.groupBy("node").agg(F.count_if("in_time").alias("replies"), F.count_if(~F.coalesce("in_time", F.lit(False))).alias("others"), F.sum(F.when(F.col("in_time"), (F.unix_micros("t2") - F.unix_micros("t1")) / 1e6)).alias("seconds"))
    want = {r.node: (r.replies, r.others, round(r.seconds, 4)) for r in want.collect()}
    assert len(want) == 4 and sum(w[0] for w in want.values()) > 500
    assert {r.node: (r.replies, r.others, round(r.seconds, 4)) for r in graph.response_counts(mails).collect()} == want
    e = edges.weights(mails)
    old = graph.number_of_emails(e).join(graph.response_score(mails), "node").join(graph.average_time(mails), "node").join(graph.degree_centrality(e), "node")
    new = graph.mail_scores(mails)
    assert sorted(map(tuple, new.collect())) == sorted(map(tuple, old.collect()))
    text = new._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join") == 2  # the nodes with their replies, and with one row


def test_messages_by_one_join(spark):
    m = plans.messages(spark, "/root/testdata/sf0.001")
    assert m._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1


def test_zones_of_many_lines(spark):
    """A text of 300 000 lines: its places are summed once, and its length is not counted for each line."""
    long = "ab\n" * 300_000
    rows = [(0, long), (1, None), (2, ""), (3, "é\n\n"), (4, "x" * 50), (5, "one\ntwo three four five\nsix\nseven eight nine ten\n")]
    for r in registry.queries()["p38_zones"](spark, _documents(spark, rows)).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line", "zone"))).alias("z")).collect():
        text = dict(rows)[r.doc_id] or ""
        n, want, a = len(text), [], 0
        for i, line in enumerate(text.split("\n")):
            b = a + len(line) + 1
            shared = [min(b, n // 4) - a, min(b, n // 2) - max(a, n // 4), min(b, n - 20) - max(a, n // 2)]
            want.append((i, "none" if max(shared) <= 0 else ("header", "body", "signature")[shared.index(max(shared))]))
            a = b
        assert [tuple(x) for x in r.z] == want


def test_terms_counted_in_their_rows(spark):
    """Unique ids: no exchange, empty and null bags too; repeated and null ids: as one document."""
    rows = [(1, ["b", "a", "b", "é"]), (2, []), (3, None), (None, ["a"]), (5, ["a"] * 70)]
    for more in ([], [(1, ["b", "c"])], [(None, ["a", "z"])]):
        df = spark.createDataFrame(rows + more, "id int, w array<string>")
        got = topics.term_counts(df, "id", F.col("w"))
        want = Counter((i, w) for i, ws in rows + more for w in ws or [])
        assert {(r.id, r.term): r.n for r in got.collect()} == want and got.count() == len(want)
        assert ("Aggregate" in got._jdf.queryExecution().optimizedPlan().toString()) == bool(more)


def test_frequencies_of_rare_terms(spark):
    terms = spark.createDataFrame([(i, f"t{t}", i * t) for i in range(9) for t in range(i, 9)], "doc_id int, term string, n int")
    df = terms.groupBy("term").agg(F.count("*").alias("d"))
    want = sorted(map(tuple, terms.join(df, "term").select("doc_id", "term", "n", "d").collect()))
    for most in (100, 5, 0):
        assert sorted(map(tuple, topics.with_frequencies(terms, df, most).select("doc_id", "term", "n", "d").collect())) == want


def test_patterns_where_needed(spark):
    texts = ["see HTTP://x.y/z", "WwW.a.b c", "a@b.org www.c@d.org", "://", "www x", None, "", "x.y", "http://a@b.org/ c@d.de"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(cleaning.drop(F.col("t"), cleaning.URL, cleaning.MAIL, by=" ").alias("a"), F.regexp_replace(F.regexp_replace(F.coalesce("t", F.lit("")), cleaning.URL, " "), cleaning.MAIL, " ").alias("b"))
    assert all(r.a == r.b for r in got.collect()) and "contains" in got._jdf.queryExecution().analyzed().toString().lower()
