"""Packing of token sequences by best-fit decreasing.

Every document is encoded, closed with an end id and cut into full windows; the
rest of it, shorter than a window, is a piece.  Within a task's pieces, longest
first, a segment tree indexed by remaining capacity finds the tightest open
window that still takes the piece.  The windows that stay loose at the end of
a task's input (one or two for millions of tokens) are cut into sequences whose
lengths are powers of two, which need no padding.

The plan is one scan with one Arrow map and no shuffle: pieces of different
tasks need not meet, as a task's thousands of pieces fill its windows.

Defined results: null text counts as empty (its document is the end id alone);
an empty table gives no row; repeated rows and ids are separate documents, and a
null id is returned as null; columns other than the two named are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commlens.llm.common import slices, utf8
from commlens.llm.tokens import crc32_u32, worker_tokenizer


class CapacityTree:
    """A segment tree over remaining capacities 0..window; a node holds the number of open windows below it."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, d: int) -> None:
        node = self.size + capacity
        while node:
            self.count[node] += d
            node >>= 1

    def put(self, capacity: int, which: int) -> None:
        self.open[capacity].append(which)
        self._add(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes the tightest window with at least ``need`` left; its capacity and number, or None."""
        count, node = self.count, self.size + need
        while not count[node]:
            while node & 1:  # a right child: nothing larger below this parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.size:
            node <<= 1
            if not count[node]:
                node += 1
        capacity = node - self.size
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> list[list[int]]:
    """Windows as lists of piece numbers; every length is 1..window."""
    tree, windows = CapacityTree(window), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n)
        if found is None:
            found = window, len(windows)
            windows.append([])
        windows[found[1]].append(i)
        if found[0] > n:
            tree.put(found[0] - n, found[1])
    return windows


def power_parts(n: int) -> list[int]:
    """Powers of two that sum to ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Packs one task's documents; rows: (row, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, window: int, loose: int):
        self.window, self.loose = window, loose
        self.pieces: list[tuple[object, int, np.ndarray, int]] = []
        self.sequence, self.held = 0, 0

    def add(self, row: object, ids: np.ndarray) -> list[tuple]:
        out, w, n = [], self.window, len(ids)
        for at in range(0, n - n % w, w):
            out.append((row, at, w, crc32_u32(ids[at : at + w]), n, self.sequence, 0))
            self.sequence += 1
        if n % w:
            self.pieces.append((row, n - n % w, ids[n - n % w :], n))
            self.held += n % w
        return out

    def flush(self) -> list[tuple]:
        out: list[tuple] = []
        for members in best_fit_decreasing(np.array([len(p[2]) for p in self.pieces], dtype=np.int64), self.window):
            used = sum(len(self.pieces[i][2]) for i in members)
            sizes = power_parts(used) if self.window - used > self.loose else [self.window]
            left, offset = sizes.pop(0), 0
            for i in members:
                row, start, ids, n = self.pieces[i]
                at = 0
                while at < len(ids):
                    if not left:
                        left, offset = sizes.pop(0), 0
                        self.sequence += 1
                    k = min(left, len(ids) - at)
                    out.append((row, start + at, k, crc32_u32(ids[at : at + k]), n, self.sequence, offset))
                    at, left, offset = at + k, left - k, offset + k
            self.sequence += 1
        self.pieces, self.held = [], 0
        return out


def pack(
    df: DataFrame, tokenizer: str, end_id: int = 2, window: int = 4096, id_col: str = "doc_id", text_col: str = "text",
    loose: int = 256, hold_tokens: int = 16_000_000, max_words: int = 500_000,
) -> DataFrame:
    """A row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``loose``: windows with more than this left after the fit are cut into powers of two.  ``hold_tokens`` bounds
    what a task holds before it packs (2 bytes a token); it is not a limit on the input.
    """
    kind = df.schema[id_col].dataType

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok = worker_tokenizer(tokenizer, max_words)
        end = np.array([end_id], dtype=tok.dtype).tobytes()
        packer = Packer(window, loose)
        first = TaskContext.get().partitionId() << 40

        def made(rows: list[tuple]) -> pa.RecordBatch:
            c = list(zip(*rows)) if rows else [[]] * 7
            whole = [pa.array(x, pa.int64()) for x in c[1:]]
            whole[4] = pa.array((np.array(c[5], dtype=np.int64) + first), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c[0], id_type), *whole], names=names)

        names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        id_type = None
        for part in slices(parts, 1):
            id_type, rows = part.schema.field(0).type, []
            for key, packed in zip(part.column(0).to_pylist(), tok.encode(part.column(1).to_pylist()), strict=True):
                rows += packer.add(key, np.frombuffer(packed + end, dtype=tok.dtype))
            if packer.held >= hold_tokens:
                rows += packer.flush()
            if rows:
                yield made(rows)
        if packer.pieces:
            yield made(packer.flush())

    schema = f"`{id_col}` {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return df.select(F.col(id_col), utf8(text_col).alias("text")).mapInArrow(run, schema)
