"""Benchmark decontamination by greedy string tiling.

Texts are lower-case word sequences.  Where a document and a benchmark item share seeds (runs of ``min_match`` words),
the longest match that is not yet marked is marked in both, again and again, until none of ``min_match`` words is
left; an item counts as leaked into a document if the marked tiles cover ``coverage`` of it.  Tiles may stand in any
order, so passages whose sentences were moved about are found like whole ones.  Matches are found by rolling
Karp-Rabin hashes of the runs and are then compared word by word.

Plan: the benchmark is a query set that is met in blocks of about ``block_words`` words (its size is counted first): a
block goes to the tasks, and the documents are scanned for it with one Arrow map and no shuffle, so a document of any
length is matched where it is read, no run of words is ever a join key, and memory is bounded by a block and a text.
A benchmark of n blocks is n such scans by the same rules; up to two million words it is one.

Defined results: null or word-less documents and items match nothing; an item of fewer than ``min_match`` words can
only match as one run of all its words; repeated documents, items and ids are reported each; null ids are kept; empty
tables give no row; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from commlens.llm.common import slices, written
from commlens.llm.side import filtered, numbered

WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x5851F42D4C957F2D)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def rolling(ids: np.ndarray, m: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of m ids."""
    if len(ids) < m:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(ids) - m + 1, np.uint64)
    for k in range(m):
        h = h * _BASE + ids[k : len(ids) - m + 1 + k].astype(np.uint64)
    return h


class Pattern:
    """An item's words as numbers, with its runs' hashes in order."""

    def __init__(self, ids: np.ndarray, min_match: int):
        self.ids = ids
        self.m = max(1, min(min_match, len(ids)))
        h = rolling(ids, self.m)
        self.at = np.argsort(h, kind="stable")
        self.hashes = h[self.at]


def tiles(doc: np.ndarray, item: Pattern, hashes: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in document, place in item, length), longest first; ties by place."""
    m = item.m
    if not len(item.ids) or len(doc) < m:
        return []
    h = rolling(doc, m) if hashes is None else hashes
    lo, hi = np.searchsorted(item.hashes, h, "left"), np.searchsorted(item.hashes, h, "right")
    n = hi - lo
    i = np.repeat(np.arange(len(h)), n)
    if not len(i):
        return []
    j = item.at[np.repeat(lo, n) + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)]
    same = np.ones(len(i), bool)
    for k in range(m):
        same &= doc[i + k] == item.ids[j + k]
    i, j = i[same], j[same]
    if not len(i):
        return []
    order = np.lexsort((i, i - j))
    i, j = i[order], j[order]
    new = np.concatenate([[True], (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1)])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(i))) + m - 1
    queue = [(-s, a, b) for s, a, b in zip(size.tolist(), i[start].tolist(), j[start].tolist(), strict=True)]
    heapq.heapify(queue)
    in_doc, in_item, out = {}, np.zeros(len(item.ids), bool), []
    while queue:
        s, a, b = heapq.heappop(queue)
        s = -s
        free = ~in_item[b : b + s]
        if in_doc:
            free &= np.array([(a + k) not in in_doc for k in range(s)])
        if free.all():
            out.append((a, b, s))
            in_item[b : b + s] = True
            in_doc.update(dict.fromkeys(range(a, a + s)))
            if in_item.all():
                break
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
        for x, y in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
            if y - x >= m:
                heapq.heappush(queue, (x - y, a + x, b + x))
    return out


class Benchmark:
    """Items that share a vocabulary; words outside it get number 0 and match nothing."""

    def __init__(self, texts: list[tuple[object, str | None]], min_match: int):
        self.min_match = min_match
        self.vocabulary: dict[str, int] = {}
        self.keys, self.items = [], []
        for key, text in texts:
            w = words_of(text)
            if w:
                self.keys.append(key)
                self.items.append(Pattern(np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w], np.int64), min_match))
        short = [(k, p) for k, p in enumerate(self.items) if p.m < min_match]
        self.short = {m: [k for k, p in short if p.m == m] for m in {p.m for _, p in short}}
        long = [(k, p) for k, p in enumerate(self.items) if p.m == min_match]
        h = np.concatenate([np.zeros(0, np.uint64), *[p.hashes for _, p in long]])
        of = np.concatenate([np.zeros(0, np.int64), *[np.full(len(p.hashes), k) for k, p in long]])
        at = np.concatenate([np.zeros(0, np.int64), *[p.at for _, p in long]])
        order = np.argsort(h, kind="stable")
        self.hashes, self.of, self.at = h[order], of[order], at[order]

    def matches(self, text: str | None, coverage: float) -> list[tuple[object, int, int, int, int]]:
        """(item, its words, words covered, tiles, first word in the document) of each leaked item."""
        get = self.vocabulary.get
        doc = np.array([get(w, 0) for w in words_of(text)], np.int64)
        out = []
        h = rolling(doc, self.min_match)
        lo, hi = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
        n = hi - lo
        hit = np.flatnonzero(n)
        candidates: list[int] = []
        if len(hit):
            lo, n = lo[hit], n[hit]
            rows = np.unique(np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
            of, at = self.of[rows], self.at[rows]
            order = np.argsort(of, kind="stable")
            of, at = of[order], at[order]
            cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(of)).tolist(), strict=True):
                k = int(of[a])
                # Tiles consist of shared runs: what these cover together bounds what tiles can cover.
                if b - a + self.min_match - 1 >= coverage * len(self.items[k].ids) or (b - a) * self.min_match >= coverage * len(self.items[k].ids):
                    candidates.append(k)
        for m, ks in self.short.items():
            own = set(rolling(doc, m).tolist())
            candidates += [k for k in ks if int(self.items[k].hashes[0]) in own]
        for k in candidates:
            item = self.items[k]
            t = tiles(doc, item, h if item.m == self.min_match else None)
            covered = sum(x[2] for x in t)
            if t and covered >= coverage * len(item.ids):
                out.append((self.keys[k], len(item.ids), covered, len(t), min(x[0] for x in t)))
        return out


OUT = "item_words long, covered_words long, n_tiles long, first_word long"


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    min_match: int = 4, coverage: float = 0.6, block_words: int = 2_000_000,
) -> DataFrame:
    """A row for each document and item that leaked into it: ids, item_words, covered_words, n_tiles, first_word."""
    spark = docs.sparkSession
    id_type, item_type = (to_arrow_type(df.schema[c].dataType) for df, c in ((docs, id_col), (benchmark, item_col)))
    schema = f"doc {docs.schema[id_col].dataType.simpleString()}, item {benchmark.schema[item_col].dataType.simpleString()}, {OUT}"
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.length("text") + 8), F.lit(0))).first()[0]
    blocks = max(1, -(-size // (8 * block_words)))
    if blocks > 1:
        items = written(items.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))), "items")
    own = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))

    def found(block: DataFrame) -> DataFrame:
        shared = spark.sparkContext.broadcast(Benchmark(sorted(((r["item"], r["text"]) for r in block.select("item", "text").collect()), key=lambda x: (str(x[0]), str(x[1]))), min_match))

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(parts, 1):
                out = [(key, *m) for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for m in shared.value.matches(text, coverage)]
                c = list(zip(*out)) if out else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, [id_type, item_type, *[pa.int64()] * 4], strict=True)], names=["doc", "item", "item_words", "covered_words", "n_tiles", "first_word"])

        return own.mapInArrow(run, schema)

    every = reduce(DataFrame.union, [found(items.where(F.col("block") == b) if blocks > 1 else items) for b in range(blocks)])
    return every.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "item_words", "covered_words", "n_tiles", "first_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` into which no item leaked; their numbers go to the written rows as side files, so texts are not shuffled."""
    own = numbered(docs, "numbered")
    texts = own.select("uid", F.col(f"c{docs.columns.index(text_col)}").alias("t"))
    leaked = contaminated(texts, benchmark, "uid", "t", item_col, item_text, **how).select("uid").distinct()
    return filtered(own, leaked, docs, keep=False)
