"""From raw documents to packed training sequences: language ID, near-duplicates, repeated passages, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
Stages are joined by written Parquet tables, so a lost executor costs the tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commlens.llm.common import documents, tokenizer_path, written
from commlens.llm.decontamination import drop_contaminated
from commlens.llm.language import identify
from commlens.llm.packing import pack
from commlens.llm.simhash import keep_one
from commlens.llm.suffix_dedup import PASSAGE_BYTES, PASSAGE_SEED, remove_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rejected: they have letters, and some language's centroid is near enough."""
    rest = tuple(c for c in docs.columns if c != "doc_id")
    return identify(docs, also=rest).where("NOT rejected").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints."""
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages of over fifty words; every document stays, ``n_chars`` is the new length.

    A passage is a string of at least ``PASSAGE_BYTES`` bytes that stands at two places; all its places lose it.
    """
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    kept = remove_repeats(docs, keep=tuple(rest), length=PASSAGE_BYTES, seed=PASSAGE_SEED).withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate), ("packing", packing),
]

#: No stage but the filters can be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
