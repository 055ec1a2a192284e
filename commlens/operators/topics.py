"""Topics: document frequencies, LDA, topic rows, order of topics, buckets of time."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commlens.operators.models import ALL
from commlens.tables import written


def document_frequency(df: DataFrame, id_col: str, words: Column) -> DataFrame:
    """(term, df): in how many documents a term occurs.  Terms are made distinct in the row, so counts combine before the shuffle."""
    return df.select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def repeated_ids(df: DataFrame, id_col: str) -> bool:
    """Do several rows have one id?  Reads the ids alone."""
    return bool(df.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").limit(1).count())


def term_counts(df: DataFrame, id_col: str, words: Column) -> DataFrame:
    """(id, term, n).  Where ids are unique, a row's terms are counted in that row and nothing is shuffled."""
    if repeated_ids(df, id_col):
        return df.select(id_col, F.explode(words).alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("n"))
    return df.select(id_col, F.inline(counted(words))).select(id_col, "term", "n")


def counted(words: Column) -> Column:
    """array<struct<term, n>>: how often each word occurs in the array."""

    @F.arrow_udf("array<struct<term: string, n: bigint>>")
    def run(lists: pa.Array) -> pa.Array:
        size = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        terms = lists.flatten().dictionary_encode()
        k = max(len(terms.dictionary), 1)
        key, n = np.unique(np.repeat(np.arange(len(lists)), size) * k + terms.indices.to_numpy(zero_copy_only=False), return_counts=True)
        at = np.searchsorted(key, np.arange(len(lists) + 1) * k)
        pairs = pa.StructArray.from_arrays([terms.dictionary.take(pa.array(key % k)), pa.array(n.astype(np.int64))], ["term", "n"])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pairs)

    return run(words)


def with_frequencies(terms: DataFrame, df: DataFrame, broadcast_rows: int = 500_000) -> DataFrame:
    """``terms`` with the ``d`` of their ``term`` in ``df`` (term, d).

    The most frequent terms, as many as fit ``broadcast_rows`` by a histogram of powers of two, go to the rows; only rows
    of rarer terms are exchanged.
    """
    by_power = df.groupBy(F.floor(F.log2("d")).cast("int").alias("p")).agg(F.count("*").alias("n")).orderBy(F.desc("p")).collect()  # at most 64 rows
    least, held = None, 0
    for r in by_power:
        held += r["n"]
        if held > broadcast_rows:
            break
        least = 2 ** r["p"]
    else:
        return terms.join(F.broadcast(df), "term")
    if least is None:
        return terms.join(df, "term")
    own = terms.join(F.broadcast(df.where(F.col("d") >= least)), "term", "left")
    return own.where("d IS NOT NULL").unionByName(own.where("d IS NULL").drop("d").join(df.where(F.col("d") < least), "term"))


def frequent_terms(df: DataFrame, id_col: str, words: Column, least: int = 3, most: float = 0.1) -> DataFrame:
    """Terms of at least ``least`` documents and at most that share of all."""
    n = df.agg(F.count("*").alias("n"))
    return document_frequency(df, id_col, words).join(F.broadcast(n)).where((F.col("df") >= least) & (F.col("df") <= most * F.col("n"))).select("term", "df")  # one row


def removed_terms(df: DataFrame, id_col: str, words: Column, least: int = 3, most: float = 0.1) -> DataFrame:
    """All other terms, by one count of the documents' words."""
    n = df.agg(F.count("*").alias("n"))
    return document_frequency(df, id_col, words).join(F.broadcast(n)).where((F.col("df") < least) | (F.col("df") > most * F.col("n"))).select("term", "df")  # one row


def buckets(df: DataFrame, ts: Column, unit: str = "month") -> DataFrame:
    """Adds ``bucket`` (start of year, month or day) and ``bucket_count``; rows without a date go.

    Counts are made first and joined, so no bucket is gathered in one task.
    """
    if unit not in ("year", "month", "day"):
        raise ValueError(unit)
    own = df.where(ts.isNotNull()).withColumn("bucket", F.date_trunc(unit, ts))
    return own.join(own.groupBy("bucket").agg(F.count("*").alias("bucket_count")), "bucket")


def train(df: DataFrame, words: str, k: int = 25, alpha: float = 0.1, beta: float = 0.1, iterations: int = 20, least: int = 3, most: float = 0.1, vocabulary: int = ALL, seed: int = 1):
    """A fitted pipeline (counts, LDA); training is distributed and nothing is collected but the model.

    The counts are written once: each iteration reads them, not the texts.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer

    n = df.count()
    vec = CountVectorizer(inputCol=words, outputCol="counts", minDF=least, maxDF=max(float(least), most * n), vocabSize=vocabulary).fit(df)
    counts = written(vec.transform(df).select("counts"), "counts")
    lda = LDA(featuresCol="counts", k=k, docConcentration=[alpha] * k, topicConcentration=beta, maxIter=iterations, optimizer="online", seed=seed).fit(counts)
    return PipelineModel([vec, lda])


def terms_of(model, top: int = 10) -> DataFrame:
    """(topic_id, terms array<struct<term, weight>>)."""
    vocabulary, lda = model.stages[0].vocabulary, model.stages[1]
    rows = [(r.topic, [(vocabulary[i], w) for i, w in zip(r.termIndices, r.termWeights)]) for r in lda.describeTopics(top).collect()]  # k rows
    t = SparkSession.active().createDataFrame(rows, "topic_id int, terms array<struct<term: string, weight: double>>")
    return t.select("topic_id", F.transform("terms", lambda t: F.struct(t["term"].alias("term"), F.round(t["weight"], 8).alias("weight"))).alias("terms"))


def hellinger(p: np.ndarray, q: np.ndarray) -> float:
    return float(np.sqrt(((np.sqrt(p) - np.sqrt(q)) ** 2).sum() / 2))


def chain(topics: np.ndarray, start: int) -> list[int]:
    """Ranks by topic: the chain goes from the start to the nearest topic that is left (ties: the larger number); k is a parameter, not data."""
    left, at, ranks = set(range(len(topics))) - {start}, start, [0] * len(topics)
    for rank in range(1, len(topics)):
        at = min(left, key=lambda t: (hellinger(topics[at], topics[t]), -t))
        left.discard(at)
        ranks[at] = rank
    return ranks


def hellinger_column(p: Column, q: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(p, q, lambda x, y: F.pow(F.sqrt(x) - F.sqrt(y), 2)), F.lit(0.0), lambda a, x: a + x) / 2)


def topic_rows(model, df: DataFrame, id_col: str, least: float = 0.02, top: int = 10) -> DataFrame:
    """(id, topic_id, topic_rank, topic_conf, terms) of topics with at least that probability."""
    from pyspark.ml.functions import vector_to_array

    dist = written(model.transform(df).select(id_col, vector_to_array("topicDistribution").alias("d")), "topics")  # read twice
    sums = [r[0] for r in dist.select(F.posexplode("d").alias("t", "p")).groupBy("t").agg(F.sum("p").alias("s")).orderBy("t").select("s").collect()]  # a row for each topic
    m = model.stages[1].topicsMatrix().toArray().T
    ranks = chain(m / np.maximum(m.sum(axis=1, keepdims=True), 1e-300), int(np.argmax(sums)) if sums else 0)
    rank = F.array(*[F.lit(r) for r in ranks])
    rows = dist.select(id_col, F.posexplode("d").alias("topic_id", "p")).where(F.col("p") >= least)
    rows = rows.select(id_col, "topic_id", F.get(rank, F.col("topic_id")).alias("topic_rank"), F.round("p", 8).alias("topic_conf"))
    return rows.join(F.broadcast(terms_of(model, top)), "topic_id").select(id_col, "topic_id", "topic_rank", "topic_conf", "terms")  # k rows


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; adds ``rank``.  Spark keeps only k rows of a group before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def shown(model, top: int = 20) -> list[str]:
    """A line for each topic: its number and its first terms with their weights; a report of k lines."""
    rows = terms_of(model, top).orderBy("topic_id").collect()
    return [f"topic # {r.topic_id} " + ", ".join(f"{t.term} {t.weight:.8f}" for t in r.terms) for r in rows]
