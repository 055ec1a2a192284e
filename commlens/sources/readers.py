"""Readers: mail files, mailboxes, JSON lines, delimited text, labelled folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commlens.functions.mime import decoded
from commlens.schema import MAIL, RAW


def eml(spark: SparkSession, folder: str, recursive: bool = True, keep_defective: bool = False) -> DataFrame:
    """doc_id (hash of the path), path, raw of each ``*.eml`` file; files that the mail parser finds defects in are left out."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=recursive, pathGlobFilter="*.eml")
    rows = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    if not keep_defective:
        rows = rows.where(decoded("raw")["defects"] == 0)
    return rows.select(F.sha2("path", 256).alias("doc_id"), "path", "raw")


def mbox(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, path, raw of the mails of mailbox files, cut at lines that begin with ``From ``."""
    rows = spark.read.text(path, lineSep="\nFrom ", recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    raw = F.regexp_replace(F.col("value"), r"^[^\n]*\n", "")  # the rest of the separating line
    return rows.select("path", raw.alias("raw")).where(F.trim("raw") != "").select(F.sha2(F.concat("path", "raw"), 256).alias("doc_id"), "path", "raw")


def json_lines(spark: SparkSession, path: str, schema: str = MAIL) -> DataFrame:
    return spark.read.schema(schema).json(path)


def delimited(spark: SparkSession, path: str, schema: str = RAW, **options) -> DataFrame:
    return spark.read.schema(schema).csv(path, multiLine=True, header=True, escape='"', **options)


def checkpoint(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """label (the file's folder), path, text of ``folder/LABEL/*``."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return files.select(F.element_at(F.split("path", "/"), -2).alias("label"), "path", "text")


def categorised(spark: SparkSession, folder: str) -> DataFrame:
    """name, text, category of pairs ``NAME.txt`` and ``NAME.cats``; a category is a line's first field."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True).select(F.regexp_extract("_metadata.file_path", r"([^/]+)\.(txt|cats)$", 1).alias("name"), F.regexp_extract("_metadata.file_path", r"\.(txt|cats)$", 1).alias("kind"), "value")
    texts, cats = files.where("kind = 'txt'"), files.where("kind = 'cats'")
    lines = cats.select("name", F.explode(F.split("value", "\n")).alias("line")).where("trim(line) <> ''")
    return texts.select("name", F.col("value").alias("text")).join(lines.select("name", F.trim(F.substring_index("line", ",", 1)).alias("category")), "name")


def exported(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of a search index's export, without the index's version field."""
    return spark.read.json(path).drop("_version_")


def pst_json(spark: SparkSession, path: str) -> DataFrame:
    """Raw mails from the JSON that a mailbox extractor writes (one object with From, To, Subject, Date, body a line)."""
    rows = spark.read.schema("`From` string, `To` string, Cc string, Subject string, `Date` string, body string").json(path)
    line = lambda k: F.when(F.col(k).isNotNull(), F.concat(F.lit(f"{k}: "), F.col(k), F.lit("\n"))).otherwise("")
    raw = F.concat(*[line(k) for k in ("From", "To", "Cc", "Subject", "Date")], F.lit("\n"), F.coalesce("body", F.lit("")))
    return rows.select(F.sha2(raw, 256).alias("doc_id"), F.lit(path).alias("path"), raw.alias("raw"))


def split_corpus(df: DataFrame, path_col: str = "path") -> DataFrame:
    """``part`` by what the path contains: train, test or eval."""
    p = F.lower(path_col)
    return df.withColumn("part", F.when(p.contains("test"), "test").when(p.contains("eval"), "eval").otherwise("train"))
