"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commlens.llm.common import documents, tokenizer_path


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from commlens.llm.simhash import near_duplicates

    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from commlens.llm.language import identify

    return identify(documents(spark, sf_dir))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from commlens.llm.quality_gam import classify

    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from commlens.llm.tool_calls import format_chats

    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from commlens.llm.wavelet import encode_and_read_back

    return encode_and_read_back(documents(spark, sf_dir), tokenizer_path())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from commlens.llm.quality_rules import judge

    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from commlens.llm.packing import pack

    return pack(documents(spark, sf_dir), tokenizer_path())


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from commlens.llm.html_wrappers import extract

    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from commlens.llm.decontamination import contaminated

    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest columns by strings of 400 bytes; ``text``, beside them, is the text without repeated passages of over fifty words."""
    from commlens.llm.suffix_dedup import PASSAGE_BYTES, remove_repeats

    return remove_repeats(documents(spark, sf_dir), text_length=PASSAGE_BYTES).withColumnRenamed("kept_text", "text")


def tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and results rendered into all conversations, as the given ones hold none: even turns call, odd ones answer, every other call needs the one before."""
    from commlens.llm.tool_calls import format_chats

    t = F.col("turn").cast("string")
    declared = F.when(F.col("turn") == 0, '<tools>[{"name": "f", "parameters": {"type": "object", "required": ["n"], "properties": {"n": {"type": "number"}}}}]</tools>').otherwise("")
    needs = F.when(F.col("turn") % 4 == 2, F.concat(F.lit('{"$ref": "c'), (F.col("turn") - 2).cast("string"), F.lit('"}'))).otherwise(t)
    call = F.concat(declared, F.lit('<tool_call>{"name": "f", "id": "c'), t, F.lit('", "arguments": {"n": '), needs, F.lit("}}</tool_call>"))
    answer = F.concat(F.lit('<tool_response>{"id": "c'), (F.col("turn") - 1).cast("string"), F.lit('", "content": {"t": '), t, F.lit(".0}}</tool_response>"))
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", F.when(F.col("turn") % 2 == 0, call).otherwise(answer).alias("text"))
    return format_chats(chats.distinct()).where("kind <> 'message'").select("conv_id", "turn", "kind", "call_id", "status", "order_turn", "order_level", "json")


TOOL_LINKS_SQL = """
WITH c AS (SELECT DISTINCT conv_id, turn FROM conversations),
r AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'call' ELSE 'result' END AS kind, 'c' || (turn - turn % 2) AS call_id, turn - turn % 2 AS called FROM c)
SELECT r.conv_id, r.turn, r.kind, r.call_id,
 CASE WHEN other.turn IS NOT NULL THEN 'ok' WHEN r.kind = 'call' THEN 'no_result' ELSE 'orphan' END AS status,
 CASE WHEN r.kind = 'result' AND other.turn IS NOT NULL THEN called ELSE r.turn END AS order_turn, 0 AS order_level,
 CASE r.kind WHEN 'call' THEN '{"arguments":{"n":' || CASE WHEN r.turn % 4 = 2 THEN '{"$ref":"c' || (r.turn - 2) || '"}' ELSE r.turn::VARCHAR END || '},"id":"' || r.call_id || '","name":"f","role":"assistant","type":"call"}'
  ELSE '{"content":{"t":' || r.turn || '},"id":"' || r.call_id || '","name":' || CASE WHEN other.turn IS NOT NULL THEN '"f"' ELSE 'null' END || ',"role":"tool","type":"result"}' END AS json
FROM r LEFT JOIN c other ON other.conv_id = r.conv_id AND other.turn = CASE r.kind WHEN 'call' THEN r.turn + 1 ELSE r.turn - 1 END"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)} | {"tool_links": tool_links}


def oracle_sql() -> dict[str, str]:
    from commlens.llm import quality_rules

    return {"op7_quality_rules": quality_rules.oracle(), "tool_links": TOOL_LINKS_SQL}
