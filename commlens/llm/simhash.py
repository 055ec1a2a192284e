"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits are linked at ``max_bits`` or fewer differing bits.  Two linked fingerprints differ in at most
t = max_bits // 2 bits of their upper or of their lower half.  The anchors of a half are the words of the [31, 26]
Hamming code, a perfect covering code of radius 1 over 31 of its bits: some anchor is within 1 of the one fingerprint
and so within 1 + t of the other.  Each distinct fingerprint is therefore replicated to every anchor within covering
radius plus threshold (16 of 2^26 or, at a code word, 1), and fingerprints are compared at their common anchors only.

Plan: one scan for fingerprints; equal ones meet in an aggregate with partial sums, so a group of exact copies of any
size is one fingerprint; replicas are dealt out by anchor, sorted, and streamed through an Arrow map that emits a
spanning forest of an anchor's links, not its pairs.  An anchor with more than ``cell`` fingerprints (a cloud of near
copies) is streamed on and compared in blocks of ``cell``, every two blocks once, each in its own task and again as
a forest.  Components come from ``components``; documents get theirs by a join that adaptive execution can split.

Defined results: null or word-less texts have fingerprint zero and are linked like any other; null ids get a row and
never are a component's id unless all are null; repeated rows and ids each keep their row; an empty table gives no row;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commlens.llm.common import slices, utf8, written
from commlens.llm.components import components
from commlens.llm.side import filtered, numbered

HALF = 31


def fingerprints_of(texts: list[bytes], shingle: int = 3) -> np.ndarray:
    """SimHash of UTF-8 texts: ASCII lower case, words between ASCII white space, shingles with repeats, XXH64 seed 42."""
    from xxhash import xxh64_digest

    out = np.zeros(len(texts), dtype=np.uint64)
    digests, sizes, rows, held = [], [], [], 0

    def settle():
        nonlocal digests, sizes, rows, held
        if rows:
            bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
            starts = np.cumsum([0, *sizes[:-1]])
            over = 2 * np.add.reduceat(bits, starts, axis=0, dtype=np.uint32) > np.array(sizes, np.uint32)[:, None]
            out[rows] = np.packbits(over, axis=1).view(">u8").ravel()
        digests, sizes, rows, held = [], [], [], 0

    for row, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            got = [xxh64_digest(joined, 42)]
        else:
            end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            lo = [0, *end[:-shingle].tolist()]
            hi = (end[shingle - 1 :] - 1).tolist()
            got = [xxh64_digest(joined[a:b], 42) for a, b in zip(lo, hi, strict=True)]
        digests.append(b"".join(got))
        sizes.append(len(got))
        rows.append(row)
        held += len(got)
        if held >= 20_000:
            settle()
    settle()
    return out


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(parts, 1):
            fp = fingerprints_of(b.column(1).to_pylist(), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=[id_col, "fp"])

    return df.select(F.col(id_col), utf8(text_col).alias("t")).mapInArrow(run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, fp long")


def anchor_masks(weight: int) -> list[np.ndarray]:
    """By syndrome: the error patterns of at most ``weight`` bits that lead to a code word of the Hamming code."""
    by: list[list[int]] = [[] for _ in range(HALF + 1)]
    for w in range(weight + 1):
        for at in combinations(range(1, HALF + 1), w):
            s = m = 0
            for p in at:
                s ^= p
                m |= 1 << (p - 1)
            by[s].append(m)
    return [np.array(x, dtype=np.int64) for x in by]


def syndromes(y: np.ndarray) -> np.ndarray:
    s = np.zeros(len(y), dtype=np.int64)
    for p in range(1, HALF + 1):
        s ^= np.where(y >> (p - 1) & 1, p, 0)
    return s


def replicas(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, fp) of every anchor within 1 + max_bits // 2 of a half; the half is the cell's highest bit."""
    masks, cells, out = anchor_masks(1 + max_bits // 2), [], []
    for half in (0, 1):
        y = fps >> (32 * half) & (1 << HALF) - 1
        s = syndromes(y)
        for k in range(HALF + 1):
            own = s == k
            if own.any():
                cells.append(((y[own, None] ^ masks[k][None, :]) | half << HALF).ravel())
                out.append(np.repeat(fps[own], len(masks[k])))
    return np.concatenate([np.zeros(0, np.int64), *cells]), np.concatenate([np.zeros(0, np.int64), *out])


def forest(a: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A spanning forest of the links among fingerprints; each step compares one with all not yet reached."""
    us, vs, rest, queue = [], [], a, []
    while len(rest) or queue:
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        x = queue.pop()
        near = np.bitwise_count((rest ^ x).view(np.uint64)) <= max_bits
        if near.any():
            found = rest[near]
            us.append(np.full(len(found), x))
            vs.append(found)
            queue.extend(found)
            rest = rest[~near]
        elif not len(rest):
            break
    return us, vs



def _compare(cell: int, max_bits: int):
    """An Arrow map over rows sorted by key: (0, u, v) for links, (1, cell, fp) for members of a cell over the limit."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = 8
        keep_k, keep_f, passing = np.zeros(0, np.int64), np.zeros(0, np.int64), None

        def made(kind, us, vs):
            u, v = np.concatenate([np.zeros(0, np.int64), *us]), np.concatenate([np.zeros(0, np.int64), *vs])
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind, np.int32)), pa.array(u), pa.array(v)], names=["kind", "u", "v"])

        def runs(k: np.ndarray, f: np.ndarray):
            starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            sizes = np.diff(np.append(starts, len(k)))
            of = np.repeat(sizes, sizes)
            us, vs = [], []
            for lag in range(1, small):
                near = (k[lag:] == k[:-lag]) & (of[lag:] <= small)
                if not near.any():
                    break
                i = np.flatnonzero(near)
                i = i[np.bitwise_count((f[i] ^ f[i + lag]).view(np.uint64)) <= max_bits]
                us.append(f[i])
                vs.append(f[i + lag])
            for s, n in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist(), strict=True):
                a, b = forest(f[s : s + n], max_bits)
                us += a
                vs += b
            return us, vs

        for b in parts:
            k = np.concatenate([keep_k, b.column(0).to_numpy(zero_copy_only=False)])
            f = np.concatenate([keep_f, b.column(1).to_numpy(zero_copy_only=False)])
            if not len(k):
                continue
            last = int(np.searchsorted(k, k[-1])) if passing != k[-1] else 0
            if passing is not None:
                n = int(np.searchsorted(k, passing, side="right"))
                if n:
                    yield made(1, [k[:n]], [f[:n]])
                    k, f = k[n:], f[n:]
                    last = max(0, last - n)
                if len(k):
                    passing = None
                    last = int(np.searchsorted(k, k[-1]))
                else:
                    keep_k, keep_f = k, f
                    continue
            us, vs = runs(k[:last], f[:last]) if last else ([], [])
            if us:
                yield made(0, us, vs)
            keep_k, keep_f = k[last:], f[last:]
            if len(keep_k) > cell:
                yield made(1, [keep_k], [keep_f])
                passing, keep_k, keep_f = keep_k[0], keep_k[:0], keep_f[:0]
        if len(keep_k):
            us, vs = runs(keep_k, keep_f)
            yield made(0, us, vs)

    return run


def _compare_blocks(max_bits: int):
    """A block pair's fingerprints: links of a forest over both."""

    def run(key, table):
        us, vs = forest(table.column("fp").to_numpy(), max_bits)
        u, v = np.concatenate([np.zeros(0, np.int64), *us]), np.concatenate([np.zeros(0, np.int64), *vs])
        return pa.table({"u": pa.array(u), "v": pa.array(v)})

    return run


def links(fps: DataFrame, max_bits: int = 3, cell: int = 16384) -> DataFrame:
    """Of distinct fingerprints (fp): links (u, v) that join every two fingerprints which a chain of links joins."""

    def replicate(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            fp = b.column(0).to_numpy()
            for at in range(0, len(fp), 4096):
                c, f = replicas(fp[at : at + 4096], max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(f)], names=["cell", "fp"])

    at = fps.select("fp").mapInArrow(replicate, "cell long, fp long")
    found = written(at.repartition("cell").sortWithinPartitions("cell").mapInArrow(_compare(cell, max_bits), "kind int, u long, v long"), "links")
    out = found.where("kind = 0").select("u", "v")
    large = found.where("kind = 1").select(F.col("u").alias("cell"), F.col("v").alias("fp"))
    sizes = large.groupBy("cell").agg(F.count("*").alias("n"))
    blocks = large.join(sizes, "cell").withColumn("blocks", F.ceil(F.col("n") / F.lit(cell)).cast("int"))
    blocks = blocks.withColumn("b", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    # Block b meets every block: with each other one in the pair (smaller, larger).
    pairs = blocks.select("cell", "fp", "b", F.explode(F.expr("sequence(0, blocks - 1)")).alias("o")).select("cell", "fp", F.least("b", "o").alias("b1"), F.greatest("b", "o").alias("b2"))
    return out.union(pairs.groupBy("cell", "b1", "b2").applyInArrow(_compare_blocks(max_bits), "u long, v long"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, cell: int = 16384) -> DataFrame:
    """A row for each row of ``df``: id, fp, component_id (smallest id of the component), root (its smallest fingerprint)."""
    own = written(fingerprint(df, id_col, text_col, shingle), "fingerprints")
    distinct = own.groupBy("fp").agg(F.min(id_col).alias("low"))
    roots = components(links(distinct, max_bits, cell))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    placed = written(placed, "roots")
    # Written, so that the joins' sides are plain exchanges and adaptive execution can split a large component or a group of copies.
    ids = written(placed.groupBy("root").agg(F.min("low").alias("component_id")), "component-ids")
    placed = written(placed.select("fp", "root").join(ids, "root"), "placed")
    return own.join(placed, "fp").select(id_col, "fp", "component_id", "root")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``df``, one of each component: the one with the smallest id (ties and null ids: the first row written).

    The numbers of the kept rows go to the written rows as side files, so texts are not shuffled.
    """
    own = numbered(df, "numbered")
    ids, texts = (F.col(f"c{df.columns.index(c)}") for c in (id_col, text_col))
    placed = near_duplicates(own.select("uid", texts.alias("t")), "uid", "t", shingle, max_bits).select("uid", "root")
    best = placed.join(own.select("uid", ids.alias("id")), "uid").groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "uid")).alias("b"))
    return filtered(own, best.select(F.col("b.uid").alias("uid")), df, keep=True)
