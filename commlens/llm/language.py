"""Language identification by nearest centroid.

A text is a vector of letter 1-, 2- and 3-grams, hashed to ``dims`` places, weighted by inverse document frequency
and scaled to length one.  Each language has several centroids, found by spherical k-means over its training vectors;
a text gets the language of the centroid with the largest cosine, and is rejected if even that is farther away than
nearly all texts of its length are.  What is far for a length comes from a fifth of the sampled texts that the
centroids do not see: their cosines, and those of pieces of 1, 2, 4, ... words of them, by powers of two of the number of
letters; the floor of a length is ``slack`` times the cosine that all but ``outside`` of these reach.

Plan: one narrow scan for the counts of a language (to set the sampling rate), one over the sampled rows for their
vectors, one for the prediction; no shuffle but that of the counts and of the sample, whose equal texts count once
(so its size is bounded however often a text or an id is repeated).  The model is a fixed number of floats.

Defined results: null, empty and letter-less texts are ``und`` with score 0 and count as rejected; rejected texts with
letters still carry the nearest language; null ids count as not held out; with nothing to learn from all texts are
``und``; repeated rows each get a row; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commlens.llm.common import slices

_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Is this code point a letter?"""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def counts(text: str | None, dims: int) -> np.ndarray | None:
    """Counts of hashed letter n-grams, words bounded by one space; None without a letter."""
    if not text:
        return None
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    c = np.where(letters()[c], c, np.uint32(32))
    gap = c == 32
    if gap.all():
        return None
    c = c[~(gap & np.concatenate([[True], gap[:-1]]))]
    c = np.concatenate([[np.uint32(32)], c[:-1] if c[-1] == 32 else c, [np.uint32(32)]])
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + c[1:] * np.uint32(0xC2B2AE35)
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0x27D4EB2F) + c[2:] * np.uint32(0x165667B1)
    shift = np.uint32(32 - (dims.bit_length() - 1))
    return sum(np.bincount((x * np.uint32(0x9E3779B1)) >> shift, minlength=dims) for x in (one, two, three))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def spherical_means(x: np.ndarray, k: int, steps: int = 15) -> np.ndarray:
    """k centroids of unit vectors; starts from the vector nearest the mean, then the farthest from those chosen."""
    chosen = [int(np.argmax(x @ unit(x.mean(axis=0))))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    c = x[chosen]
    for _ in range(steps):
        near = np.argmax(x @ c.T, axis=1)
        c = np.stack([unit(x[near == i].mean(axis=0)) if (near == i).any() else c[i] for i in range(len(c))])
    return c


class Centroids:
    """langs[i] is the language of centroid i; idf weights; floors[k]: the least cosine not rejected for 2^k letters and more."""

    def __init__(self, langs: list[str], centroids: np.ndarray, idf: np.ndarray, floors: np.ndarray):
        self.langs, self.centroids, self.idf, self.floors = langs, centroids.astype(np.float32), idf.astype(np.float32), floors

    def vector(self, n: np.ndarray) -> np.ndarray:
        return unit(np.sqrt(n.astype(np.float32)) * self.idf)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        n = counts(text, len(self.idf))
        if n is None or not self.langs:
            return "und", 0.0, True
        cos = self.centroids @ self.vector(n)
        i = int(np.argmax(cos))
        return self.langs[i], float(min(1.0, max(0.0, cos[i]))), bool(cos[i] < self.floors[min(size_of(n), len(self.floors) - 1)])


def size_of(n: np.ndarray) -> int:
    """The power of two of a text's letters, from its counts: three n-grams for each letter or gap."""
    return max(0, int(n.sum()) // 3).bit_length()


def floors_of(sizes: np.ndarray, cosines: np.ndarray, outside: float, slack: float, least: int = 100, most: int = 40) -> np.ndarray:
    """By size: ``slack`` times the cosine that all but ``outside`` of the texts of that size reach; sizes with fewer than ``least`` take a shorter one's."""
    out, last = np.zeros(most), 1e-6
    for k in range(most):
        own = cosines[sizes == k]
        if len(own) >= least:
            last = max(1e-6, slack * float(np.quantile(own, outside)))
        out[k] = last
    return np.minimum.accumulate(out[::-1])[::-1]  # a longer text never has the lower floor


def held_out(id_col: str, mod: int, rest: int):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod == rest, F.lit(False))


def train(df: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_lang: int, clusters: int, dims: int, outside: float, slack: float) -> Centroids:
    """Learns from about ``docs_per_lang`` different texts of each language that are not held out, chosen by a hash of the text."""
    own = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col, 3, 1)).select(F.col(lang_col).cast("string").alias("l"), F.col(text_col).alias("t"))
    sizes = {r[0]: r[1] for r in own.groupBy("l").count().collect()}  # a row for each language
    rate = F.lit(0.0)
    for lang, n in sizes.items():
        rate = F.when(F.col("l") == lang, F.lit(min(1.0, docs_per_lang / n))).otherwise(rate)
    sample = own.withColumn("h", F.xxhash64("t")).where(F.pmod("h", F.lit(1 << 20)) < rate * (1 << 20)).groupBy("l", "h").agg(F.first("t").alias("t"))

    def vectors(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(parts, 2):
            rows = []
            for lang, h, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                unseen, words = (h >> 20) % 5 == 0, text.split()
                pieces = [text]
                if unseen:  # to set the floors
                    pieces += [" ".join(words[(h >> 24) % (len(words) - k + 1) :][:k]) for k in (1 << i for i in range(30)) if k < len(words)]
                for i, piece in enumerate(pieces):
                    c = counts(piece, dims)
                    if c is not None:
                        at = np.flatnonzero(c)
                        rows.append((lang, unseen, at.astype("<i4").tobytes(), c[at].astype("<f4").tobytes()))
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, (pa.string(), pa.bool_(), pa.binary(), pa.binary()), strict=True)], names=["lang", "unseen", "at", "n"])

    rows = sample.mapInArrow(vectors, "lang string, unseen boolean, at binary, n binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["n"])))
    seen = [r for r in rows if not r["unseen"]] or rows
    x = np.zeros((len(seen), dims), np.float32)
    for i, r in enumerate(seen):
        x[i, np.frombuffer(r["at"], "<i4")] = np.frombuffer(r["n"], "<f4")
    idf = np.log((1 + len(seen)) / (1 + (x > 0).sum(axis=0))) + 0.1
    v, of = unit(np.sqrt(x, out=x) * idf.astype(np.float32)), np.array([r["lang"] for r in seen])
    langs, parts = [], []
    for lang in sorted(set(of)):
        c = spherical_means(v[of == lang], clusters)
        langs += [lang] * len(c)
        parts.append(c)
    model = Centroids(langs, np.concatenate([np.zeros((0, dims)), *parts]), idf, np.zeros(1))
    got = []
    for r in (r for r in rows if r["unseen"] and langs):
        n = np.zeros(dims, np.float32)
        n[np.frombuffer(r["at"], "<i4")] = np.frombuffer(r["n"], "<f4")
        got.append((size_of(n), float((model.centroids @ model.vector(n)).max())))
    model.floors = floors_of(np.array([g[0] for g in got]), np.array([g[1] for g in got]), outside, slack)
    return model


def identify(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = 1000, clusters: int = 4, dims: int = 4096,
    also: tuple[str, ...] = (), outside: float = 0.002, slack: float = 0.9,
) -> DataFrame:
    """id, ``also`` columns, held_out, lang_pred, score, rejected.  lang, source and id are no inputs of a prediction.

    ``docs_per_lang`` bounds the sample that is learned from; every row is predicted.
    """
    spark = df.sparkSession
    model = spark.sparkContext.broadcast(train(df, id_col, text_col, lang_col, docs_per_lang, clusters, dims, outside, slack))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(parts, 0):
            got = [model.value.predict(t) for t in b.column(0).to_pylist()]
            lang, score, rejected = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=[*b.schema.names[1:], "lang_pred", "score", "rejected"])

    names = [id_col, *also]
    picked = df.select(F.col(text_col).alias("t"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(names)], held_out(id_col, 3, 1).alias("h"))
    schema = ", ".join([*(f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(names)), "h boolean, lang_pred string, score double, rejected boolean"])
    return picked.mapInArrow(run, schema).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)], F.col("h").alias("held_out"), "lang_pred", "score", "rejected")
