"""Chat formatting by tool-call linking.

Messages are rows (conversation, turn, role, text).  A text may hold tool blocks, JSON objects between marks:
``<tools>[{"name", "parameters"}]</tools>`` declares tools, ``<tool_call>{"id", "name", "arguments"}</tool_call>`` calls
one and ``<tool_response>{"id", "content"}</tool_response>`` answers a call.  An argument value ``{"$ref": id}`` at any
depth says that the call needs the answer of another call.  Then

1. calls and results meet in a hash join on (conversation, id), calls and schemas in one on (conversation, tool name);
2. calls are put in topological order by peeling: a call is placed when all calls it refers to are, at
   max((own turn, 0), (turn, level + 1) of those); what is never placed is in a cycle or behind one;
3. arguments are validated against the tool's schema (``tools`` holds schemas for conversations that declare none);
4. every item becomes one line of canonical JSON (sorted keys, shortest numbers, no spaces).

Plan: messages are a scan and an Arrow map without a shuffle, a row for each item, so a conversation of any length is
never in one task; the order is a key (order_turn, order_level, turn, kind, item), not a position.  Only tool blocks are shuffled, on
keys finer than a conversation.  Peeling takes as many rounds as the longest chain of references, each written.

Defined results: a null text counts as empty, a null role as "", null turns are kept, the rows with a null conversation id are one conversation, a null id never links, a null turn counts as 0 in the order of calls; a block
that is not valid JSON, is nested too deeply to parse, lacks its fields or has an id or a name that is no string of valid Unicode
has status ``bad_json`` (lone surrogates inside other values stay escaped); a schema that is none gives ``bad_schema``; of calls with one id in a conversation the first (turn, item) is
linked and later ones are ``duplicate_id``; of results the first is ``ok`` and later ones ``duplicate_result``; results
without a call are ``orphan``; calls without a result ``no_result``; repeated rows count as repeated blocks; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commlens.llm.common import dropped, written

BLOCK = re.compile(r"<(tools|tool_call|tool_response)>(.*?)</\1>", re.S)
LONE = re.compile("[\ud800-\udfff]")
MESSAGE, CALL, RESULT, TOOL = 0, 1, 2, 3
KIND = {"tools": TOOL, "tool_call": CALL, "tool_response": RESULT}
FIELDS = "kind int, item int, id string, name string, body string, args string, refs array<string>, bad boolean"
ARROW = [pa.int32(), pa.int32(), *[pa.string()] * 4, pa.list_(pa.string()), pa.bool_()]


def number(x: int | float) -> str:
    """The shortest form that reads back as the same number; whole doubles below 1e21 without a fraction."""
    if isinstance(x, int):
        return str(x)
    if not math.isfinite(x):
        raise ValueError("no JSON number")
    if x == int(x) and abs(x) < 1e21:
        return str(int(x))
    text = repr(x)
    if "e" in text:
        mantissa, exponent = text.split("e")
        power = int(exponent)
        if -7 < power < 21:
            return f"{x:.{max(0, len(mantissa.replace('-', '').replace('.', '')) - 1 - power)}f}"
        return f"{mantissa.removesuffix('.0')}e{'+' if power > 0 else '-'}{abs(power)}"
    return text


def canonical(x: object) -> str:
    """Canonical JSON of a parsed value: members by the UTF-16 units of their names, no white space; lone surrogates stay escaped."""
    if isinstance(x, str):
        return LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", json.dumps(x, ensure_ascii=False))
    if x is None or isinstance(x, bool):
        return json.dumps(x)
    if isinstance(x, (int, float)):
        return number(x)
    if isinstance(x, list):
        return "[" + ",".join(map(canonical, x)) + "]"
    keys = sorted(x, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
    return "{" + ",".join(f"{canonical(k)}:{canonical(x[k])}" for k in keys) + "}"


def references(x: object) -> set[str]:
    if isinstance(x, dict):
        own = {x["$ref"]} if set(x) == {"$ref"} and isinstance(x["$ref"], str) else set()
        return own.union(*map(references, x.values()))
    return set().union(*map(references, x)) if isinstance(x, list) else set()


def _is(kind: str, x: object) -> bool:
    number_ = isinstance(x, (int, float)) and not isinstance(x, bool)
    return {
        "object": isinstance(x, dict), "array": isinstance(x, list), "string": isinstance(x, str), "boolean": isinstance(x, bool),
        "null": x is None, "number": number_, "integer": number_ and x == int(x),
    }.get(kind, False)


def valid(x: object, schema: object) -> bool:
    """Does a value meet a schema (type, enum, const, properties, required, additionalProperties, items, bounds, pattern)?  References stand for any value."""
    if isinstance(schema, bool):
        return schema
    if isinstance(x, dict) and set(x) == {"$ref"}:
        return True
    kinds = schema.get("type")
    if kinds is not None and not any(_is(k, x) for k in (kinds if isinstance(kinds, list) else [kinds])):
        return False
    if "enum" in schema and canonical(x) not in map(canonical, schema["enum"]) or "const" in schema and canonical(x) != canonical(schema["const"]):
        return False
    if isinstance(x, str):
        return schema.get("minLength", 0) <= len(x) <= schema.get("maxLength", math.inf) and ("pattern" not in schema or re.search(schema["pattern"], x) is not None)
    if isinstance(x, dict):
        own = schema.get("properties", {})
        return all(k in x for k in schema.get("required", ())) and all(valid(v, own[k] if k in own else schema.get("additionalProperties", True)) for k, v in x.items())
    if isinstance(x, list):
        return schema.get("minItems", 0) <= len(x) <= schema.get("maxItems", math.inf) and all(valid(v, schema.get("items", True)) for v in x)
    if _is("number", x):
        return schema.get("minimum", -math.inf) <= x <= schema.get("maximum", math.inf)
    return True


def _text(x: object, null: bool = False) -> str | None:
    """An id or a name: a string that is valid Unicode, or, where allowed, null."""
    if isinstance(x, str) and not LONE.search(x) or x is None and null:
        return x
    raise ValueError("an id or a name is a string")


def blocks_of(text: str) -> list[tuple]:
    """The FIELDS of each tool block of a text."""
    out: list[tuple] = []
    for item, m in enumerate(BLOCK.finditer(text)):
        kind = KIND[m[1]]
        try:
            x = json.loads(m[2])
            if kind == TOOL:
                out += [(kind, item, None, _text(t["name"]), None, canonical(t.get("parameters", {})), None, False) for t in x]
                continue
            id_ = _text(x.get("id"), null=True)
            if kind == CALL:
                args, name = x["arguments"], _text(x["name"])
                args = json.loads(args) if isinstance(args, str) else args
                body = canonical({"arguments": args, "id": id_, "name": name, "role": "assistant", "type": "call"})
                # No id holds a lone surrogate, so such a reference is one to an unknown call.
                out.append((kind, item, id_, name, body, canonical(args), sorted(r for r in references(args) if not LONE.search(r)), False))
            else:
                out.append((kind, item, id_, None, canonical(x.get("content")), None, None, False))
        except (ValueError, KeyError, TypeError, AttributeError, RecursionError):
            out.append((kind, item, None, None, canonical(m[2]), None, None, True))
    return out


def _blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in parts:
        rows, at = [], []
        for i, text in enumerate(b.column("text").to_pylist()):
            own = blocks_of(text)
            rows += own
            at += [i] * len(own)
        kept = b.take(pa.array(at, pa.int64()))
        cols = list(zip(*rows)) if rows else [()] * len(ARROW)
        names = [f.split(" ")[0] for f in FIELDS.split(", ")]
        yield pa.RecordBatch.from_arrays([kept.column("conv"), kept.column("turn"), *[pa.array(c, k) for c, k in zip(cols, ARROW, strict=True)]], names=["conv", "turn", *names])


def _messages(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in parts:
        lines = []
        for role, text in zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True):
            text = BLOCK.sub("", text).strip() if "<tool" in text else text
            lines.append(canonical({"content": text, "role": role, "type": "message"}))
        yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("turn"), pa.array(lines, pa.string())], names=["conv", "turn", "json"])


def _validated(tools: dict[str, dict]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            said = []
            for name, args, schema in zip(b.column("name").to_pylist(), b.column("args").to_pylist(), b.column("schema").to_pylist(), strict=True):
                own = json.loads(schema) if schema is not None else tools.get(name)
                try:
                    said.append("bad_json" if args is None else "unknown_tool" if own is None else "ok" if valid(json.loads(args), own) else "invalid_arguments")
                except (re.error, TypeError, AttributeError, ValueError, OverflowError, RecursionError):
                    said.append("bad_schema")
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("conv", "turn", "item", "id", "name", "body", "refs")], pa.array(said, pa.string())], names=["conv", "turn", "item", "id", "name", "body", "refs", "said"])

    return run


def placed(calls: DataFrame) -> DataFrame:
    """(conv, id, order_turn, order_level) of calls (conv, id, turn, refs) that no cycle holds back; references to unknown ids do not.

    A round joins the open references with the calls that the round before placed, no others; an open reference keeps
    the key of the call that it waited for.
    """
    every = calls.select("conv", "id")
    needs = calls.select("conv", "id", "turn", F.explode("refs").alias("ref")).join(every.withColumnRenamed("id", "ref"), ["conv", "ref"], "left_semi").distinct()
    needs = written(needs.withColumn("key", F.lit(None).cast("struct<t: long, l: int>")), "needs")
    free = calls.join(needs.select("conv", "id").distinct(), ["conv", "id"], "left_anti")
    new = written(free.select("conv", "id", F.col("turn").alias("order_turn"), F.lit(0).alias("order_level")), "placed")
    done = [new]
    while True:
        found = new.select("conv", F.col("id").alias("ref"), F.struct(F.col("order_turn").alias("t"), (F.col("order_level") + 1).alias("l")).alias("now"))
        met = needs.join(found, ["conv", "ref"], "left").select("conv", "id", "turn", "ref", F.coalesce("key", "now").alias("key"))
        met, before = written(met, "needs"), needs
        dropped(before)
        ready = met.groupBy("conv", "id").agg(F.max("key").alias("k"), F.first("turn").alias("turn"), F.max(F.col("key").isNull()).alias("open")).where("NOT open")
        key = F.greatest("k", F.struct(F.col("turn").alias("t"), F.lit(0).alias("l")))
        new = written(ready.select("conv", "id", key["t"].alias("order_turn"), key["l"].alias("order_level")), "placed")
        if not new.limit(1).count():
            return reduce(DataFrame.union, done)
        done.append(new)
        if len(done) == 32:
            done = [written(reduce(DataFrame.union, done), "placed")]
        needs = written(met.join(new.select("conv", "id"), ["conv", "id"], "left_anti"), "needs")
        dropped(met)


def format_chats(df: DataFrame, tools: dict[str, dict] | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row for each message, call and result: conversation, turn, kind, item, call_id, name, status, order_turn, order_level, json."""
    # Keys without null, so that the rows without a conversation are one like any other.
    key = F.coalesce(F.concat(F.lit("c"), F.col(conv_col).cast("string")), F.lit("-"))
    own = df.select(key.alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    conv = "string"
    lines = own.mapInArrow(_messages, f"conv {conv}, turn long, json string")
    none = F.lit(None).cast("string")
    messages = lines.select("conv", "turn", F.lit("message").alias("kind"), F.lit(0).alias("item"), none.alias("call_id"), none.alias("name"), F.lit("ok").alias("status"), F.col("turn").alias("order_turn"), F.lit(-1).alias("order_level"), "json")

    items = written(own.where(F.contains("text", F.lit("<tool"))).select("conv", "turn", "text").mapInArrow(_blocks, f"conv {conv}, turn long, {FIELDS}"), "tool-items")
    # Written, so that adaptive execution can split the calls of one conversation's tool.
    declared = written(items.where(f"kind = {TOOL} AND name IS NOT NULL").groupBy("conv", "name").agg(F.min_by("args", F.struct("turn", "item")).alias("schema")), "declared")
    calls = items.where(f"kind = {CALL}").select("conv", "turn", "item", "id", "name", "body", "args", "refs").join(declared, ["conv", "name"], "left")
    calls = calls.select("conv", "turn", "item", "id", "name", "body", "args", "refs", "schema").mapInArrow(
        _validated(tools or {}), f"conv {conv}, turn long, item int, id string, name string, body string, refs array<string>, said string"
    )
    calls = written(calls, "calls")
    first = calls.where("id IS NOT NULL").groupBy("conv", "id").agg(
        F.min(F.struct("turn", "item")).alias("at"), F.min_by("refs", F.struct("turn", "item")).alias("refs"), F.min_by("name", F.struct("turn", "item")).alias("call_name")
    )
    order = placed(first.select("conv", "id", F.coalesce("at.turn", F.lit(0)).alias("turn"), "refs"))
    first = written(first.join(order, ["conv", "id"], "left").select("conv", "id", "at", "call_name", "order_turn", "order_level"), "first-calls")
    results = items.where(f"kind = {RESULT}")
    answers = written(results.where("id IS NOT NULL").groupBy("conv", "id").agg(F.min(F.struct("turn", "item")).alias("answer")), "answers")
    call_rows = calls.join(first, ["conv", "id"], "left").join(answers, ["conv", "id"], "left")
    is_first = F.col("at.turn").eqNullSafe(F.col("turn")) & F.col("at.item").eqNullSafe(F.col("item"))
    status = F.when(F.col("said") == "bad_json", "bad_json").when(F.col("id").isNull(), "no_id").when(~is_first, "duplicate_id")
    status = status.when(F.col("order_turn").isNull(), "cycle").when(F.col("said") != "ok", F.col("said")).when(F.col("answer").isNull(), "no_result").otherwise("ok")
    linked = is_first & F.col("order_turn").isNotNull()
    call_rows = call_rows.select(
        "conv", "turn", F.lit("call").alias("kind"), "item", F.col("id").alias("call_id"), "name", status.alias("status"),
        F.when(linked, F.col("order_turn")).otherwise(F.col("turn")).alias("order_turn"), F.when(linked, F.col("order_level")).otherwise(0).alias("order_level"), F.col("body").alias("json"),
    )
    out = results.join(first, ["conv", "id"], "left").join(answers, ["conv", "id"], "left")
    is_answer = F.col("answer.turn").eqNullSafe(F.col("turn")) & F.col("answer.item").eqNullSafe(F.col("item"))
    status = F.when(F.col("bad"), "bad_json").when(F.col("at").isNull(), "orphan").when(~is_answer, "duplicate_result").otherwise("ok")
    # A struct's JSON without {"x": and } is the string's.
    inner = lambda c: F.expr(f"substring(to_json(named_struct('x', {c})), 6, length(to_json(named_struct('x', {c}))) - 6)")
    quoted_or_null = lambda c: F.when(F.col(c).isNull(), "null").otherwise(inner(c))
    line = F.concat(F.lit('{"content":'), "body", F.lit(',"id":'), quoted_or_null("id"), F.lit(',"name":'), quoted_or_null("call_name"), F.lit(',"role":"tool","type":"result"}'))
    result_rows = out.select(
        "conv", "turn", F.lit("result").alias("kind"), "item", F.col("id").alias("call_id"), F.col("call_name").alias("name"), status.alias("status"),
        F.coalesce("order_turn", "turn").alias("order_turn"), F.coalesce("order_level", F.lit(0)).alias("order_level"), line.alias("json"),
    )
    shown = F.when(F.col("conv") != "-", F.substring("conv", 2, 1 << 30)).cast(df.schema[conv_col].dataType)
    return messages.union(call_rows).union(result_rows).withColumn("conv", shown).withColumnRenamed("conv", conv_col)
