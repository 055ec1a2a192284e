"""Removal of byte strings of ``length`` bytes that start at two or more places, by column-wise construction.

The named method inserts one symbol per document each round and updates an ordering (the collection's
Burrows-Wheeler transform) with common prefixes.  Over whole documents that takes as many rounds as the longest
document has bytes, each passing over all that was built before; see the README for figures.  Here documents are
first cut at content: among the ``seed``-byte strings of a window of ``length`` bytes, the one with the least hash is
the window's seed.  Equal windows have equal seeds at equal places, so a repeat can only be between fragments (a
seed's windows, under 2 * length bytes) that share a seed, and those are aligned at it.  Then

1. fragments are counted by seed: a seed that occurs once takes no further part; a seed whose fragments are all
   equal is decided by its count; of a seed with different fragments the equal ones are decided by their count;
2. one fragment of each kind of the mixed seeds is fetched, and the construction runs column by column over them:
   each round inserts one symbol per fragment, keeps the order of the fragments by what they hold up to there, and
   updates the common length of neighbours; where it reaches ``length``, a repeated window ends;
3. the fragments of a mixed seed with more than ``group`` kinds never meet in one task: their windows are counted by
   their 128-bit hashes, with partial sums.

Plan: the texts are written once with row numbers; only seeds (about one for every 150 bytes) are shuffled, twice,
by hash, and texts never are: requests and results go back to the text partitions as side files, each read by the
tasks that scan that partition.  Memory of a task is bounded by a text and a few thousand fragments.

Defined results: null text counts as empty; texts shorter than ``length`` keep all; repeated rows are separate places
(so equal rows of that length go wholly), null and repeated ids each keep their row; an empty table gives no row;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commlens.llm.common import deleted, dropped, positions, slices, utf8, written
from commlens.llm.side import Side, side_files

CHUNK = 1 << 18
PAD = 256
#: Fifty-one words of prose have more bytes than this: passages of over fifty words are found as repeats of so many.
PASSAGE_BYTES, PASSAGE_SEED = 240, 60
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        up, down = np.full(n, _BASE), np.full(n, inverse)
        up[0] = down[0] = 1
        have = _POWERS[0] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have[0][:n], have[1][:n]


def window_seeds(b: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of bytes (at least ``length``): for each run of windows with one seed: first and last start, seed place, seed hash."""
    n, w = len(b), length - seed + 1
    up, down = _powers(n + 1)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum(b * up[:n], out=s[1:])
    h = (s[seed:] - s[:-seed]) * down[: n - seed + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    low = np.uint64(0xFFFFFF)
    cur, size = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
    m = len(h) - w + 1
    while 2 * size <= w:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    at = (np.minimum(cur[:m], cur[w - size : w - size + m]) & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(first[1:], m) - 1
    return first, last, at[first], h[at[first]]


def text_seeds(text: bytes, length: int, seed: int) -> list[tuple[np.ndarray, ...]]:
    """``window_seeds`` of a text of any length, in overlapping chunks; places are those in the text."""
    out, b = [], np.frombuffer(text, np.uint8)
    for at in range(0, len(b) - length + 1, CHUNK):
        a, z, p, h = window_seeds(b[at : at + CHUNK + length - 1], length, seed)
        out.append((a + at, z + at, p + at, h))
    return out


def repeated_windows(group: np.ndarray, text: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int) -> np.ndarray:
    """Column-wise construction over aligned fragments.

    group: fragments of equal group (in runs) are compared.  text: fragments x columns, bytes or, where a fragment has
    none, PAD, which no byte equals.  lo, hi: the first and the last column at which a window of each fragment starts.
    True where such a window stands in another fragment too.
    """
    m, cols = text.shape
    found = np.zeros((m, max(cols - length + 1, 0)), dtype=bool)
    if m < 2 or not found.shape[1]:
        return found
    order = np.argsort(group, kind="stable")
    g = np.unique(group, return_inverse=True)[1].astype(np.int64)
    d = np.zeros(m + 1, dtype=np.int64)  # d[i]: from which column on the i-th in order agrees with the one before
    new_group = np.concatenate([[True], g[order][1:] != g[order][:-1]])
    never = cols + 1
    d[:m][new_group] = never
    d[m] = never
    for j in range(cols):
        key = g[order] << 9 | text[order, j]
        perm = np.argsort(key, kind="stable")
        same = key[perm][1:] == key[perm][:-1]
        # What now stands side by side agrees from the latest of the columns between them in the old order.
        ends = np.empty(2 * (m - 1), dtype=np.int64)
        ends[0::2] = np.minimum(perm[:-1], perm[1:]) + 1
        ends[1::2] = np.maximum(perm[:-1], perm[1:]) + 1
        between = np.maximum.reduceat(d, ends)[0::2]
        d[1:m] = np.where(same, between, j + 1)
        d[:m][new_group] = never
        order = order[perm]
        s = j + 1 - length
        if s >= 0:
            dup = np.minimum(d[:m], d[1:]) <= s
            found[order[dup], s] = True
    at = np.arange(found.shape[1])
    return found & (at >= lo[:, None]) & (at <= hi[:, None])


SEEDS = "h1 long, h2 long, uid long, a int, p int, b int"
FRAGMENTS = "h1 long, n long, uid long, a int, p int, b int, frag binary"


def _find_seeds(length: int, seed: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        def made(rows):
            h1, h2, uid, a, p, b = (np.concatenate(x) for x in zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(uid), *[pa.array(x.astype(np.int32)) for x in (a, p, b)]], names=["h1", "h2", "uid", "a", "p", "b"]
            )

        for batch in slices(parts, 1):
            rows, held = [], 0
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if len(text) < length:
                    continue
                for a, b, p, h1 in text_seeds(text, length, seed):
                    h2 = np.fromiter((xxh3_64_intdigest(text[x:y]) for x, y in zip(a.tolist(), (b + length).tolist(), strict=True)), np.uint64, len(a))
                    rows.append((h1, h2, np.full(len(a), uid, np.int64), a, p, b))
                    held += len(a)
                if held > 50_000:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    return run


def _fetch(folder: str, length: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = Side(folder)
        for batch in slices(parts, 2):
            out = []
            for part, idx, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                lo, hi = side.rows(part, idx)
                c = side.cols
                for i in range(lo, hi):
                    a, b = int(c["a"][i]), int(c["b"][i])
                    out.append((int(c["h1"][i]), int(c["n"][i]), part << 33 | idx, a, int(c["p"][i]), b, text[a : b + length]))
            if out:
                kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=["h1", "n", "uid", "a", "p", "b", "frag"])

    return run


def _spans_of(found: np.ndarray, uid, a, p, left: int, length: int) -> list[tuple[int, int, int]]:
    """(uid, lo, hi) of the bytes that the found windows cover; ``left`` is the seed's column."""
    out = []
    row, col = np.nonzero(found)
    if len(row):
        cut = np.flatnonzero((row[1:] != row[:-1]) | (col[1:] > col[:-1] + length)) + 1
        s, e = np.concatenate([[0], cut]), np.concatenate([cut, [len(row)]]) - 1
        for i, j in zip(s.tolist(), e.tolist(), strict=True):
            r = row[i]
            out.append((int(uid[r]), int(p[r] - left + col[i]), int(p[r] - left + col[j] + length)))
    return out


def _construct(length: int, seed: int, group: int, hold: int = 8192):
    """An Arrow map over fragments sorted by seed: spans (uid, lo, hi); fragments of seeds with more kinds than ``group`` pass with their bytes."""
    left = length - seed
    cols = 2 * left + seed

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def made(spans, members=()):
            u = [s[0] for s in spans] + [m[2] for m in members]
            lo = [s[1] for s in spans] + [m[3] for m in members]
            hi = [s[2] for s in spans] + [m[5] for m in members]
            f = [None] * len(spans) + [m[6] for m in members]
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(f, pa.binary())], names=["uid", "lo", "hi", "frag"])

        def solve(rows: list[tuple]):
            if len(rows) < 2:
                return []
            h, n, uid, a, p, b, frags = zip(*rows)
            h, uid, a, p, b = (np.array(x, dtype=np.int64) for x in (h, uid, a, p, b))
            text = np.full((len(rows), cols), PAD, np.uint16)
            at = left - (p - a)
            for i, f in enumerate(frags):
                text[i, at[i] : at[i] + len(f)] = np.frombuffer(f, np.uint8)
            found = repeated_windows(h, text, left + a - p, left + b - p, length)
            return _spans_of(found, uid, a, p, left, length)

        for batch in parts:
            large = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if row[1] > group:
                    large.append(row)
                    continue
                if held and row[0] != held[-1][0] and len(held) >= hold:
                    yield made(solve(held))
                    held = []
                held.append(row)
            if large:
                yield made((), large)
        if held:
            yield made(solve(held))

    return run


def _window_hashes(length: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in parts:
            for uid, lo, hi, frag in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                h = np.frombuffer(b"".join(xxh3_128_digest(frag[i : i + length]) for i in range(hi - lo + 1)), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(np.full(len(h), uid)), pa.array(np.arange(lo, hi + 1))], names=["w1", "w2", "uid", "lo"])

    return run


def _left(text: bytes, side: Side, part: int, idx: int) -> tuple[bytes, int]:
    """What is left of a text without the spans of its row, and the number of maximal removed runs."""
    i, j = side.rows(part, idx)
    if i == j:
        return text, 0
    spans, kept, at, end = 0, [], 0, -1
    o = np.argsort(side.cols["lo"][i:j], kind="stable")
    for x, y in zip(side.cols["lo"][i:j][o].tolist(), side.cols["hi"][i:j][o].tolist(), strict=True):
        if x > end:
            spans += 1
            kept.append(text[at:x])
        end = at = max(end, y)
    return b"".join([*kept, text[at:]]), spans


def _cut(folders: list[str]):
    """An Arrow map: sizes and digest by the first folder's spans, the text by the last one's."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [Side(f) for f in folders]
        for batch in slices(parts, 2):
            out = []
            for part, idx, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                left, spans = _left(text, sides[0], part, idx)
                shown = _left(text, sides[1], part, idx)[0] if len(sides) > 1 else left
                out.append((len(text), len(text) - len(left), spans, hashlib.sha256(left).hexdigest(), shown.decode("utf-8", "ignore")))
            c = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], *[pa.array(x, k) for x, k in zip(c, kinds, strict=True)]], names=[*batch.schema.names[3:], "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return run


def repeats(own: DataFrame, length: int, seed: int, group: int) -> str:
    """Side files of the spans (lo, hi) that cover the repeated strings of ``length`` bytes of ``own`` (uid, t); spans may overlap.

    Tables of the way there are deleted when nothing needs them any more.
    """
    seeds = written(own.select("uid", "t").mapInArrow(_find_seeds(length, seed), SEEDS), "seeds")
    # Written, so that the join's sides are plain exchanges and adaptive execution can split a seed that holds a third of the rows.
    shared = written(seeds.groupBy("h1").agg(F.count("*").alias("n"), (F.min("h2") != F.max("h2")).alias("mixed")).where("n > 1").select("h1", "mixed"), "shared-seeds")
    among = written(seeds.join(shared, "h1"), "shared")
    dropped(seeds)
    kinds = among.where("mixed").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("uid", "a", "p", "b")).alias("r"))
    kinds = written(kinds.select("h1", "h2", "n", "r.*"), "kinds")
    # Written by itself, so that adaptive execution can split the copies of one fragment.
    equal = written(among.where("mixed").join(kinds.where("n > 1").select("h1", "h2"), ["h1", "h2"], "left_semi").select("uid", "a", "b"), "equal")
    per_seed = written(kinds.groupBy("h1").agg(F.count("*").alias("n")), "kinds-by-seed")
    wanted = side_files(kinds.drop("n").join(per_seed, "h1").select(*positions(), "h1", "n", "a", "p", "b"), "wanted")
    fragments = own.select(*positions(), "t").mapInArrow(_fetch(wanted, length), FRAGMENTS)
    # Fragments of a seed meet in one task only where there are at most ``group``; those of larger ones are dealt out by text.
    salt = F.when(F.col("n") > group, F.xxhash64("uid", "a")).otherwise(0)
    solved = fragments.repartition("h1", salt).sortWithinPartitions("h1").mapInArrow(_construct(length, seed, group), "uid long, lo long, hi long, frag binary")
    solved = written(solved, "solved")
    windows = solved.where("frag IS NOT NULL").mapInArrow(_window_hashes(length), "w1 long, w2 long, uid long, lo long")
    twice = written(windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1"), "twice")
    spans = (
        among.where("NOT mixed").select("uid", "a", "b").union(equal).select("uid", F.col("a").cast("long").alias("lo"), (F.col("b") + length).cast("long").alias("hi"))
        .union(solved.where("frag IS NULL").select("uid", "lo", "hi"))
        .union(windows.join(twice, ["w1", "w2"], "left_semi").select("uid", "lo", (F.col("lo") + length).alias("hi")))
    )
    marks = side_files(spans.select(*positions(), "lo", "hi"), "marks")
    for table in (shared, among, kinds, equal, per_seed, solved, twice):
        dropped(table)
    deleted(own.sparkSession, wanted)
    return marks


def remove_repeats(
    df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), length: int = 400, seed: int = 100, group: int = 4096,
    text_length: int | None = None, text_seed: int = PASSAGE_SEED,
) -> DataFrame:
    """The ``keep`` columns and n_bytes, n_removed, n_spans, kept_sha256, kept_text (a character cut through is left out).

    ``text_length``: kept_text is what is left when repeated strings of this many bytes are removed instead of those of
    ``length``, which the other columns stay about.
    """
    columns = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    own = written(df.select(F.monotonically_increasing_id().alias("uid"), utf8(text_col).alias("t"), *columns), "texts")
    marks = [repeats(own, n, s, group) for n, s in ((length, seed), (text_length, text_seed)) if n]
    kept = ", ".join(f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = own.select(*positions(), "t", *[f"k{i}" for i in range(len(keep))]).mapInArrow(_cut(marks), f"{kept}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
