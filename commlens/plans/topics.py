"""Queries: topics, buckets, classification, clustering, sinks, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from commlens.functions import cleaning as cl
from commlens.operators import models, topics
from commlens.plans.mails import table
from commlens.plans.registry import query
from commlens.plans.texts import _BAG, bag_sql
from commlens.sources import sinks
from commlens.tables import shared_path, written


def _bags(spark, sf_dir, *more):
    return table(spark, sf_dir, "documents").select("doc_id", *more, cl.bag_of_words(F.col("text")).alias("words"))


_DF = f"WITH w AS (SELECT DISTINCT doc_id, unnest({_BAG}) AS term FROM documents), df AS (SELECT term, count(*) AS df FROM w GROUP BY 1), n AS (SELECT count(*) AS n FROM documents)"


@query("a9_frequent_terms", f"{_DF} SELECT term, df FROM df, n WHERE df >= 3 AND df <= 0.1 * n")
def a9(spark, sf_dir):
    return topics.frequent_terms(_bags(spark, sf_dir), "doc_id", F.col("words"))


@query("a10_old_variant", f"{_DF.replace(_BAG, bag_sql(numbers=True))} SELECT term, df FROM df, n WHERE df >= 3 AND df <= 0.05 * n")
def a10(spark, sf_dir):
    bags = table(spark, sf_dir, "documents").select("doc_id", cl.bag_of_words(F.col("text"), numbers=True).alias("words"))
    return topics.frequent_terms(bags, "doc_id", F.col("words"), 3, 0.05)


@query("u3_removed_terms", f"{_DF} SELECT term, df FROM df, n WHERE NOT (df >= 3 AND df <= 0.1 * n)")
def u3(spark, sf_dir):
    return topics.removed_terms(_bags(spark, sf_dir), "doc_id", F.col("words"))


for _unit in ("year", "month", "day"):

    @query(f"a8_buckets_{_unit}", f"SELECT o_orderkey, date_trunc('{_unit}', o_orderdate)::TIMESTAMP AS bucket, count(*) OVER (PARTITION BY date_trunc('{_unit}', o_orderdate)) AS bucket_count FROM orders WHERE o_orderdate IS NOT NULL")
    def a8(spark, sf_dir, unit=_unit):
        return topics.buckets(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), F.col("o_orderdate"), unit).select("o_orderkey", "bucket", "bucket_count")


def _model(spark, sf_dir):
    bags = written(_bags(spark, sf_dir), "bags")  # words are found once, not once a pass
    return topics.train(bags, "words"), bags


@query("m2_k1_topic_terms")
def m2(spark, sf_dir):
    model, _ = _model(spark, sf_dir)
    return topics.terms_of(model, 10).select("topic_id", F.posexplode("terms").alias("pos", "t")).select("topic_id", "pos", "t.term", "t.weight")


@query("m3_old_topics")
def m3(spark, sf_dir):
    bags = written(_bags(spark, sf_dir), "bags")
    model = topics.train(bags, "words", k=100, alpha=50 / 100, most=0.05)
    return topics.terms_of(model, 10).select("topic_id", F.posexplode("terms").alias("pos", "t")).select("topic_id", "pos", "t.term", "t.weight")


@query("m4_t4_f4_topic_rows")
def m4(spark, sf_dir):
    model, bags = _model(spark, sf_dir)
    return topics.topic_rows(model, bags, "doc_id").select("doc_id", "topic_id", "topic_rank", "topic_conf")


_EMB = "list_transform(embedding, lambda x: abs(x)::DOUBLE)"


@query("m5_hellinger", f"""
WITH p AS (SELECT vec_id, {_EMB} AS a FROM embeddings), q AS (SELECT vec_id, list_transform(a, lambda x: x / list_sum(a)) AS p FROM p), f AS (SELECT p AS q FROM q WHERE vec_id = 0)
SELECT vec_id, round(sqrt(list_sum(list_transform(list_zip(p, q), lambda z: pow(sqrt(z[1]) - sqrt(z[2]), 2))) / 2), 6)::DOUBLE AS distance FROM q, f""")
def m5(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.abs(x).cast("double")).alias("a"))
    p = e.select("vec_id", F.transform("a", lambda x: x / F.aggregate("a", F.lit(0.0), lambda s, y: s + y)).alias("p"))
    first = p.where("vec_id = 0").select(F.col("p").alias("q"))
    return p.join(F.broadcast(first)).select("vec_id", F.round(topics.hellinger_column(F.col("p"), F.col("q")), 6).alias("distance"))  # one row


@query("m6_category")
def m6(spark, sf_dir):
    bags = written(_bags(spark, sf_dir, "lang"), "bags")  # words are found once, not once a pass of either model
    d = written(bags.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"), "labelled")
    labels, model = models.classifier(d, "words", "lang")
    sub_labels, sub = models.classifier(d.withColumn("quality", F.col("quality").cast("string")), "words", "quality")
    out = models.predicted(labels, model, bags.select("doc_id", "words"), "category")
    out = models.predicted(sub_labels, sub, out, "subcategory")
    return out.select("doc_id", "top_category", models.category(F.col("top_category"), F.col("top_subcategory"), "en").alias("top_subcategory"))


@query("m7_clusters")
def m7(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector

    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    return models.clusters(e, "v", 10).transform(e).groupBy("cluster").agg(F.count("*").alias("n"), F.countDistinct("label").alias("labels"))


@query("m7_nearest", """
WITH q AS (SELECT vec_id AS q, embedding AS a FROM embeddings WHERE vec_id % 100 = 0),
d AS (SELECT q, vec_id AS neighbour, round(sqrt(list_sum(list_transform(list_zip(a, embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))), 6)::DOUBLE AS distance FROM q, embeddings WHERE vec_id <> q)
SELECT q AS vec_id, neighbour, distance, row_number() OVER (PARTITION BY q ORDER BY distance, neighbour)::INT AS rank FROM d QUALIFY row_number() OVER (PARTITION BY q ORDER BY distance, neighbour) <= 5""")
def m7n(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return models.nearest(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 5)


@query("m8_m9_tfidf_pca")
def m8(spark, sf_dir):
    from pyspark.ml import Pipeline

    bags = written(_bags(spark, sf_dir), "bags")  # words are found once, not once a pass
    model = Pipeline(stages=models.tfidf("words", "x", 5, 0.7)).fit(bags)
    rows = written(models.sparse(model.transform(bags), "doc_id", "x"), "tfidf")  # read once a round
    out = models.reduced(rows, models.components(rows, len(model.stages[0].vocabulary), 4), "pca")
    return out.select("doc_id", F.size("pca").alias("dimensions"), F.round(F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)), 6).alias("length"))


@query("a13_insights")
def a13(spark, sf_dir):
    d = _bags(spark, sf_dir, "source").withColumn("long", (F.size("words") > 200).cast("double"))
    w = d.select("source", "doc_id", F.explode("words").alias("term")).groupBy("source", "doc_id", "term").agg(F.count("*").alias("n"))
    total = w.groupBy("source", "doc_id").agg(F.sum("n").alias("t"))
    w = w.join(total, ["source", "doc_id"]).select("source", "term", (F.col("n") / F.col("t")).alias("weight"))
    return models.insights(d, "source", w, ["long"], 10).select("source", F.size("words").alias("words"), F.round("long", 6).alias("long"))


@query("s7_flattened", "SELECT doc_id, lang AS \"meta.lang\", n_chars AS \"meta.size.chars\", source AS \"meta.source\" FROM documents")
def s7(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.struct("lang", F.struct(F.col("n_chars").alias("chars")).alias("size"), "source").alias("meta"))
    return sinks.flat(d)


@query("f3_has_date", "SELECT event_id FROM events WHERE ts IS NOT NULL")
def f3(spark, sf_dir):
    return table(spark, sf_dir, "events").where("ts IS NOT NULL").select("event_id")


def _drained(stream, name):
    """All that a stream yields over the files that are there now, from a table in the shared folder."""
    import uuid

    from commlens.tables import shared_dir

    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/commlens-{name}-{uuid.uuid4().hex}"
    stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@query("stream_a1_without_repeats", "SELECT event_id, user_id FROM events")
def stream_a1(spark, sf_dir):
    from commlens.streaming.streams import source, without_repeats

    events = table(spark, sf_dir, "events")
    twice = shared_path(spark, "events-twice")  # every event comes twice, in files of their own
    events.unionAll(events).write.parquet(twice)
    stream = source(spark, twice, events.schema)
    return _drained(without_repeats(stream, "ts", ["event_id"], "60 days"), "events").select("event_id", "user_id")
