"""Keyphrases: candidates and their graph rank per chunk of text, means over chunks, tagging."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commlens.functions.cleaning import STOPWORDS

TOKEN = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
ASCII_TOKEN = re.compile(r"[a-z0-9]+(?:['-][a-z0-9]+)*")
_STOP = frozenset(STOPWORDS)


def windows_covering(first: int, last: int, n: int, width: int) -> int:
    """In how many windows both places stand: w = min(n, width), windows start at 0 to n - w + 1 and reach w places beyond their start."""
    w = min(n, width)
    return max(0, min(first, n - w + 1, n - 1) - max(0, last - w) + 1)


def _together(at: list[tuple[int, int]], k: int, n: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of log distances and numbers of common windows for each two of ``k`` terms; ``at``: sorted (place, term)."""
    place, term = np.array(at).T
    m, number = np.zeros(k * k), np.zeros(k * k)
    ends = np.searchsorted(place, place + w, side="right")
    for a in range(0, len(at), 256):
        size = np.maximum(ends[a : a + 256] - np.arange(a, min(a + 256, len(at))) - 1, 0)
        i = np.repeat(np.arange(a, a + len(size)), size)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size)
        first, last = place[i], place[j]
        cover = np.maximum(np.minimum(first, min(n - w + 1, n - 1)) - np.maximum(last - w, 0) + 1, 0) * (term[i] != term[j])
        key = term[i] * k + term[j]
        m += np.bincount(key, cover * np.log(w / np.maximum(last - first, 1)), k * k)
        number += np.bincount(key, cover, k * k)
    m, number = m.reshape(k, k), number.reshape(k, k)
    return m + m.T, number + number.T


def _tokens(text: str) -> list[str]:
    """Lower-case tokens.  A whole text is lowered at once where that gives the same: no letter in it grows or depends on its neighbours."""
    if text.isascii():
        return ASCII_TOKEN.findall(text.lower())
    if "İ" in text or "Σ" in text:
        return [t.lower() for t in TOKEN.findall(text)]
    return TOKEN.findall(text.lower())


def _candidates(tokens: list[str], lengths: tuple[int, ...], least: float, most: int) -> list[tuple[int, int, list[int]]]:
    """The ``most`` phrases with the most places, equal ones in order: (first place, size, places).

    A phrase is a run of tokens without stopwords and numbers, longer than 6 characters.  Tokens hold nothing that sorts
    before a space, so phrases are in the order of their lists of tokens; places sorted by what follows them have all
    places of a phrase side by side, and a phrase that none of its neighbours shares occurs once.
    """
    n, sizes = len(tokens), sorted(set(lengths))
    longest, shortest = sizes[-1], sizes[0]
    plain = {t for t in set(tokens) if t not in _STOP and not t.isdigit()}
    follow: list[tuple[list[str], int]] = []
    end = n
    for i in range(n - 1, -1, -1):
        if tokens[i] not in plain:
            end = i
        elif end - i >= shortest:
            follow.append((tokens[i : min(end, i + longest)], i))
    follow.sort()
    common = [0] * (len(follow) + 1)  # with the place before
    for k in range(1, len(follow)):
        x, y = follow[k - 1][0], follow[k][0]
        if x[0] == y[0]:
            m, top = 1, min(len(x), len(y))
            while m < top and x[m] == y[m]:
                m += 1
            common[k] = m
    long = lambda words, size: size > 3 or sum(map(len, words[:size])) + size - 1 > 6
    repeated: list[tuple[int, int, list[int]]] = []
    single: list[tuple[int, int, list[int]]] = []
    open_: dict[int, list[int]] = {}
    full = least > 1
    for k, (words, i) in enumerate(follow):
        before, shared = common[k], common[k + 1]
        if before > shared:
            shared = before
        if full and shared < shortest:
            continue
        for size in sizes:
            if size > len(words):
                break
            if size <= before:
                open_[size].append(i)
            elif size <= shared:
                open_[size] = [i]
                if long(words, size):
                    repeated.append((i, size, open_[size]))
            elif full:
                break
            elif long(words, size):
                single.append((i, size, [i]))
                full = len(single) >= most
    repeated = [r for r in repeated if len(r[2]) >= least]
    repeated.sort(key=lambda r: -len(r[2]))
    return (repeated + single)[:most]


def keyphrases(text: str, top: int = 100, lengths: tuple[int, ...] = (2, 3, 4, 5, 6), window: int = 1000, prefilter: int = 100, rounds: int = 30) -> list[tuple[str, float]]:
    """(phrase, score), best first; equal scores by phrase, last first.  A window is no wider than the text."""
    tokens = _tokens(text or "")
    n = len(tokens)
    kept = _candidates(tokens, lengths, min(n / 1000, 4), max(3 * top, prefilter))
    begins: dict[int, list[tuple[int, int]]] = {}
    for k, (_, size, at) in enumerate(kept):
        for i in at:
            begins.setdefault(i, []).append((i + size, k))
    inside = [0] * len(kept)
    for own, (i, size, at) in enumerate(kept):
        found = [k for j in range(i, i + size) if j in begins for e, k in begins[j] if e <= i + size and k != own]
        for k in set(found) if len(at) > 1 or len(found) > 1 else found:
            inside[k] += len(at)
    weight, places = {}, {}
    for less, (i, size, at) in zip(inside, kept):
        w = (len(at) - less) * math.sqrt(size)
        if w > 0:
            p = " ".join(tokens[i : i + size])
            weight[p], places[p] = w, at
    terms = sorted(weight)
    if not terms:
        return []
    m, number = _together(sorted((i, k) for k, p in enumerate(terms) for i in places[p]), len(terms), n, min(n, window))
    w = np.array([weight[t] for t in terms])
    edge = np.where(number > 0, (1 + m) / np.maximum(number, 1), 0) * w[:, None] * w[None, :]
    total = edge.sum(axis=1, keepdims=True)
    p = np.where(total > 0, edge / np.maximum(total, 1e-300), 1 / len(terms))
    rank = np.full(len(terms), 1 / len(terms))
    for _ in range(rounds):
        rank = 0.15 / len(terms) + 0.85 * rank @ p
    return sorted(zip(terms, rank.round(12).tolist()), key=lambda x: (x[1], x[0]), reverse=True)[:top]


def chunk_phrases(df: DataFrame, id_col: str, text_col: str, chunk: int = 10_000, **how) -> DataFrame:
    """(id, chunk, phrase, score): every text cut into chunks of ``chunk`` characters, each ranked where it is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, at = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                for k in range(0, len(text or ""), chunk):
                    got = keyphrases(text[k : k + chunk], **how)
                    rows += [(k // chunk, p, s) for p, s in got]
                    at += [i] * len(got)
            c = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(c[0], pa.int32()), pa.array(c[1], pa.string()), pa.array(c[2], pa.float64())], names=["id", "chunk", "phrase", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, chunk int, phrase string, score double").withColumnRenamed("id", id_col)


def mean_scores(df: DataFrame, phrase: Column, score: Column) -> DataFrame:
    """(phrase, score, chunks): the mean over chunks by lower-cased phrase."""
    return df.groupBy(F.lower(phrase).alias("phrase")).agg(F.avg(score).alias("score"), F.count("*").alias("chunks"))


def tagged(docs: DataFrame, phrases: list[tuple[str, float]], text: Column, as_: str = "keyphrases") -> DataFrame:
    """Adds array<struct<phrase, score>> of those of the top phrases (a report of stated length) that the text contains, in their order."""
    table = F.array(*[F.struct(F.lit(p).alias("phrase"), F.lit(s).alias("score")) for p, s in phrases])
    if not phrases:
        table = F.array().cast("array<struct<phrase:string,score:double>>")
    return docs.withColumn(as_, F.filter(table, lambda x: F.contains(text, x["phrase"])))
