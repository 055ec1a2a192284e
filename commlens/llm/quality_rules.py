"""Quality rules as weak supervision, native: DataFrame and SQL functions only.

Each rule votes for a document (1), against it (-1) or abstains (0).  Expectation-maximisation over the counts of
vote patterns (at most 3 to the power of the number of rules, whatever the input) estimates how often each rule
gives each vote to good and to bad documents; the posterior probability of "good" replaces all-must-pass filtering.

Plan: one scan computes features and votes and writes them, without texts, to the shared folder; pattern counts are
one aggregate with partial sums; the estimate is one small aggregate a step; the verdict is a projection whose
parameters are literals.  No document is shuffled.

Defined results: null or empty text has no words and fails the base; null or repeated ids are kept as they are, a row
each; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commlens.llm.common import written

WS = r"\x20\x09-\x0D"
BLANKS = "concat(' ', char(9), char(10), char(11), char(12), char(13))"

#: Positions of words within 3-word windows that occur twice or more, counted.  ``w``: the words.  Windows are sorted
#: by hash, then words, so equal ones are neighbours; the work is n log n for a text of any length.
REPEATS = """
transform(array(words), w -> CASE WHEN size(w) < 4 THEN 0L ELSE
 transform(array(transform(sequence(1, size(w) - 2), i -> xxhash64(w[i - 1], w[i], w[i + 1]))), h ->
  CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE
   transform(array(sort_array(transform(h, (x, i) -> named_struct('h', x, 'a', w[i], 'b', w[i + 1], 'c', w[i + 2], 'i', i)))), s ->
    transform(array(sort_array(transform(filter(s, (x, k) ->
       coalesce(x.h = get(s, k - 1).h AND x.a = get(s, k - 1).a AND x.b = get(s, k - 1).b AND x.c = get(s, k - 1).c, false)
       OR coalesce(x.h = get(s, k + 1).h AND x.a = get(s, k + 1).a AND x.b = get(s, k + 1).b AND x.c = get(s, k + 1).c, false)), x -> x.i))), p ->
     aggregate(transform(p, (x, k) -> least(3, coalesce(get(p, k + 1), x + 3) - x)), 0L, (a, x) -> a + x))[0])[0]
  END)[0]
 END)[0]
"""

#: name -> (bad if, good if), over the features; the first that holds votes, neither: abstains.  Most rules only ever
#: vote against, as an unbroken rule says little; the three general ones vote both ways.
RULES = {
    "v_length": ("n_words < 50", "n_words >= 80"),
    "v_ends": ("10 * n_ended_lines < n_lines", "2 * n_ended_lines >= n_lines"),
    "v_word_size": ("word_chars < 3 * n_words OR word_chars > 12 * n_words", "word_chars BETWEEN 4 * n_words AND 9 * n_words"),
    "v_repeats": ("100 * n_repeat_words > 30 * n_words", "false"),
    "v_symbols": ("5 * n_symbols > n_words", "false"),
    "v_letters": ("20 * n_letters < 17 * word_chars", "false"),
    "v_cells": ("5 * n_cells > n_words", "false"),
    "v_lines": ("4 * n_dup_lines > n_lines", "false"),
    "v_case": ("5 * n_upper > 2 * word_chars", "false"),
    "v_marks": ("2 * n_exclaim > n_words", "false"),
}
TWO_WAYS = ("v_length", "v_ends", "v_word_size")
BASE_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_cells", "n_upper", "n_exclaim", "n_ended_lines"]


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts that the rules look at, a row for each row of ``df``."""
    t = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.select(
        id_col, "text", F.expr(rf"regexp_extract_all(text, r'[^{WS}]+', 0)").alias("words"),
        F.expr(rf"filter(split(text, '\n'), x -> x rlike r'[^{WS}]')").alias("lines"),
    )
    return t.select(
        id_col,
        F.size("words").cast("long").alias("n_words"),
        F.expr(f"length(translate(text, {BLANKS}, ''))").cast("long").alias("word_chars"),
        F.expr("length(text) - length(translate(text, '#*$%&|<>', ''))").cast("long").alias("n_symbols"),
        F.expr("size(lines) - size(array_distinct(lines))").cast("long").alias("n_dup_lines"),
        F.expr(REPEATS).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.expr("length(text) - length(replace(text, '|', ''))").cast("long").alias("n_cells"),
        F.expr(r"length(regexp_replace(text, r'\P{L}+', ''))").cast("long").alias("n_letters"),
        F.expr("length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÎÏÔÖÙÛÜÁÍÓÚÑ', ''))").cast("long").alias("n_upper"),
        F.expr("length(text) - length(translate(text, '!', ''))").cast("long").alias("n_exclaim"),
        F.expr(rf"size(filter(lines, x -> x rlike r'[.!?:][{WS}]*$'))").cast("long").alias("n_ended_lines"),
    )


def votes() -> list[Column]:
    return [F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END").alias(k) for k, (bad, good) in RULES.items()]


def start() -> dict:
    """Before the first step, and the estimate's prior: most documents are good, and rules are right more often than not."""
    p = {"prior": 0.9}
    for k in RULES:
        good, bad = ((0.01, 0.19, 0.8), (0.2, 0.25, 0.55)) if k in TWO_WAYS else ((0.01, 0.98, 0.01), (0.3, 0.69, 0.01))
        for v in (-1, 0, 1):
            p[k, v, 1], p[k, v, 0] = good[v + 1], bad[v + 1]
    return p


def _name(k: str, v: int) -> str:
    return f"{k}_{'nzp'[v + 1]}"


def posterior_sql(p: dict) -> str:
    """Probability that a document with these votes is good; parameters as literals."""
    terms = [repr(math.log(p["prior"] / (1 - p["prior"])))]
    for k in RULES:
        odds = {v: math.log(p[k, v, 1] / p[k, v, 0]) for v in (-1, 0, 1)}
        terms.append(f"CASE {k} WHEN -1 THEN {odds[-1]!r}D WHEN 0 THEN {odds[0]!r}D ELSE {odds[1]!r}D END")
    terms[0] += "D"
    return f"(1D / (1D + exp(-({' + '.join(terms)}))))"


def estimate(patterns: DataFrame, steps: int = 20, weight: float = 0.1) -> dict:
    """Expectation-maximisation over (votes, n); one small aggregate a step.  An empty table keeps the start.

    ``weight``: the start counts as so many times the documents, which keeps "good" and "bad" from changing places.
    """
    first = p = start()
    for _ in range(steps):
        with_q = patterns.select("*", (F.expr(posterior_sql(p)) * F.col("n")).alias("g"))
        sums = [F.sum("n").alias("total"), F.sum("g").alias("good")]
        sums += [F.sum(F.when(F.col(k) == v, F.col(c))).alias(_name(k, v) + "_" + c) for k in RULES for v in (-1, 0, 1) for c in ("n", "g")]
        r = with_q.agg(*sums).first()
        if not r["total"]:
            return p
        good, bad, own = r["good"], r["total"] - r["good"], weight * r["total"]
        p = {"prior": (good + own * first["prior"]) / (r["total"] + own)}
        for k in RULES:
            for v in (-1, 0, 1):
                g, n = r[_name(k, v) + "_g"] or 0.0, r[_name(k, v) + "_n"] or 0
                p[k, v, 1] = (g + own * first["prior"] * first[k, v, 1]) / (good + own * first["prior"])
                p[k, v, 0] = (max(n - g, 0.0) + own * (1 - first["prior"]) * first[k, v, 0]) / (bad + own * (1 - first["prior"]))
    return p


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_from: float = 0.5, steps: int = 20) -> DataFrame:
    """A row for each document: id, counts, votes, ``posterior``, ``base_failed``, ``kept``."""
    f = written(features(df, id_col, text_col).select("*", *votes()), "votes")
    patterns = written(f.groupBy(*RULES).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    p = estimate(patterns, steps)
    return (
        f.withColumn("posterior", F.expr(posterior_sql(p)))
        .withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from))
    )


def oracle(steps: int = 20, weight: float = 0.1, keep_from: float = 0.5) -> str:
    """The same in DuckDB's SQL over ``documents``, each step of the estimate a common table expression."""
    ws = r"[^\x20\x09-\x0D]"
    rules = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS {k}" for k, (bad, good) in RULES.items())
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÎÏÔÖÙÛÜÁÍÓÚÑ"
    p0 = start()

    def odds(at: str) -> str:
        per = " + ".join(f"CASE t.{k} WHEN -1 THEN ln({at}.{_name(k, -1)}_1 / {at}.{_name(k, -1)}_0) WHEN 0 THEN ln({at}.{_name(k, 0)}_1 / {at}.{_name(k, 0)}_0) ELSE ln({at}.{_name(k, 1)}_1 / {at}.{_name(k, 1)}_0) END" for k in RULES)
        return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-(ln({at}.prior / (1 - {at}.prior)) + {per}))))"

    first = ", ".join([f"{p0['prior']}::DOUBLE AS prior"] + [f"{p0[k, v, y]}::DOUBLE AS {_name(k, v)}_{y}" for k in RULES for v in (-1, 0, 1) for y in (0, 1)])
    ctes = [f"p0 AS MATERIALIZED (SELECT {first})"]
    for i in range(steps):
        w1, w0 = weight * p0["prior"], weight * (1 - p0["prior"])
        sums = ", ".join(
            f"(coalesce(sum(g) FILTER ({k} = {v}), 0) + {w1 * p0[k, v, 1]} * sum(n)) / (sum(g) + {w1} * sum(n)) AS {_name(k, v)}_1, "
            f"(greatest(coalesce(sum(n) FILTER ({k} = {v}), 0) - coalesce(sum(g) FILTER ({k} = {v}), 0), 0) + {w0 * p0[k, v, 0]} * sum(n)) / (sum(n) - sum(g) + {w0} * sum(n)) AS {_name(k, v)}_0"
            for k in RULES for v in (-1, 0, 1)
        )
        ctes.append(f"p{i + 1} AS MATERIALIZED (SELECT (sum(g) + {w1} * sum(n)) / (sum(n) * {1 + weight}) AS prior, {sums} FROM (SELECT t.*, t.n * {odds('q')} AS g FROM patterns t, p{i} q))")
    return f"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '{ws}+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{ws}')) AS l FROM base),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM pos),
rep AS (SELECT doc_id, count(DISTINCT j) AS r FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM win WHERE c >= 2) GROUP BY doc_id),
f AS (SELECT words.doc_id, len(w)::BIGINT AS n_words, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS wc,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(r, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, (length(text) - length(replace(text, '|', '')))::BIGINT AS n_cells, length(regexp_replace(text, '\\P{{L}}+', '', 'g'))::BIGINT AS n_letters, length(regexp_replace(text, '[^{upper}]', '', 'g'))::BIGINT AS n_upper,
  length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclaim, len(list_filter(l, lambda x: regexp_matches(x, '[.!?:][\\x20\\x09-\\x0D]*$')))::BIGINT AS n_ended_lines
  FROM words LEFT JOIN rep ON words.doc_id = rep.doc_id),
g AS (SELECT *, coalesce(wc, 0)::BIGINT AS word_chars FROM f),
v AS MATERIALIZED (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {rules} FROM g),
patterns AS MATERIALIZED (SELECT {", ".join(RULES)}, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
{", ".join(ctes)}
SELECT t.doc_id, t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, {BASE_FAILED} AS base_failed,
  (NOT {BASE_FAILED}) AND {odds(f"p{steps}")} >= {keep_from} AS kept
FROM v t, p{steps}
"""
