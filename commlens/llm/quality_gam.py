"""Quality classification by a generalised additive model with pairwise interactions.

Texts become a fixed list of features, features become bins, and each feature has a lookup table over its bins that
cyclic boosting of shallow trees fills: round by round, feature by feature, a tree of a few leaves over the bins'
gradient sums adds a small step to that feature's table.  The pairs of features whose four quadrants explain most of
what is left get two-dimensional tables in the same way.  A score is the sum of table entries, taken for a whole
batch at once, through the logistic function.

Plan: the sampled rows' features meet the labels in an equi-join of a few numbers a row; scoring is one scan with one
Arrow map and no shuffle.  The fit is bounded by ``train_rows``, a documented parameter; the tables are of fixed size.

Defined results: null text counts as empty and is scored like any text; rows with a null id count as not held out and
have no label; null labels are not learned from; without any label all scores are 0.5; repeated rows each get a row;
of labels with the same id the mean is learned, from one of the texts with that id; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commlens.llm.common import slices
from commlens.llm.language import held_out

FEATURES = (
    "log_words", "word_size", "symbols", "upper", "exclaims", "cells", "dup_lines", "repeats", "distinct", "ended_lines", "digits",
    "wide", "line_size", "marks", "letters", "capitals", "vowels", "spaces",
)
_SETS = {k: np.zeros(256, bool) for k in ("symbols", "upper", "digits", "marks", "letters", "vowels", "spaces")}
for _k, _chars in {"symbols": b"#*$%&|<>@~^=+", "upper": bytes(range(65, 91)), "digits": b"0123456789", "marks": b".,;:!?'\"()-", "letters": bytes([*range(65, 91), *range(97, 123), *range(128, 256)]), "vowels": b"aeiouAEIOU", "spaces": b" \t\n\r\x0b\x0c"}.items():
    _SETS[_k][list(_chars)] = True


def features_of(text: bytes) -> list[float]:
    """Values of FEATURES for a UTF-8 text; each is finite, also for an empty one."""
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = max(1, len(text))
    words = text.split()
    w = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    k = max(1, len(lines))
    solid = max(1, size - int(n[_SETS["spaces"]].sum()))
    of = {name: int(n[s].sum()) for name, s in _SETS.items()}
    repeats = 0.0
    if len(words) > 3:
        h = np.fromiter(map(hash, words), np.int64, len(words))
        t = h[:-2] * np.int64(0x5851F42D4C957F2D) ^ h[1:-1] * np.int64(0x14057B7EF767814F) ^ h[2:]
        t.sort()
        repeats = float((t[1:] == t[:-1]).mean())
    ended = sum(x.rstrip()[-1] in b".!?:" for x in lines)
    return [
        float(np.log1p(len(words))), solid / w, of["symbols"] / w, of["upper"] / solid, int(n[33]) / w, int(n[124]) / w, 1 - len(set(lines)) / k if lines else 0.0, repeats,
        len(set(words)) / w, ended / k, of["digits"] / solid, int(n[128:].sum()) / solid, float(np.log1p(size / k)), of["marks"] / w, of["letters"] / solid,
        sum(map(bytes.istitle, words)) / w, of["vowels"] / max(1, of["letters"]), of["spaces"] / size,
    ]


class Gam:
    """base + sum of tables[f][bin] + sum of pair tables; edges[f] are the bins' upper ends."""

    def __init__(self, edges: list[np.ndarray], base: float):
        self.edges, self.base = edges, base
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1)

    def raw(self, b: np.ndarray) -> np.ndarray:
        out = np.full(len(b), self.base)
        for f, t in enumerate(self.tables):
            out += t[b[:, f]]
        for i, j, t in self.pairs:
            out += t[b[:, i], b[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(self.bins(x))))


def _shallow(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float, least: float) -> np.ndarray:
    """Leaf values by bin of a tree over ordered bins: the best split of all leaves, again and again."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    cuts = [0, len(g)]

    def worth(a, b):
        return (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)

    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                m = np.arange(a + 1, b)
                gain = worth(a, m) + worth(m, b) - worth(a, b)
                gain[(ch[m] - ch[a] < least) | (ch[b] - ch[m] < least)] = 0
                i = int(np.argmax(gain))
                best = max(best, (float(gain[i]), int(m[i])), key=lambda z: z[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int, int]:
    """The cut of a table in four with the greatest gain: (gain, row, column)."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    G, H = cg[-1, -1], ch[-1, -1]
    a, ha = cg[:-1, :-1], ch[:-1, :-1]
    b, hb = cg[:-1, -1:] - a, ch[:-1, -1:] - ha
    c, hc = cg[-1:, :-1] - a, ch[-1:, :-1] - ha
    d, hd = G - a - b - c, H - ha - hb - hc
    if not a.size:
        return 0.0, 0, 0
    gain = a**2 / (ha + ridge) + b**2 / (hb + ridge) + c**2 / (hc + ridge) + d**2 / (hd + ridge) - G**2 / (H + ridge)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return float(gain[i, j]), int(i) + 1, int(j) + 1


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, pairs: int = 6, bins: int = 48, rate: float = 0.1, leaves: int = 3, ridge: float = 1.0, least: float = 2.0) -> Gam:
    """Cyclic boosting; x: rows x features, y: 0 to 1."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    p = (y.sum() + 1) / (len(y) + 2)
    model = Gam(edges, float(np.log(p / (1 - p))))
    b = model.bins(x)
    raw = model.raw(b)
    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            q = 1 / (1 + np.exp(-raw))
            step = rate * _shallow(np.bincount(b[:, f], y - q, len(table)), np.bincount(b[:, f], q * (1 - q), len(table)), leaves, ridge, least)
            table += step
            raw += step[b[:, f]]
    q = 1 / (1 + np.exp(-raw))
    found = []

    def sums(i, j, v):
        ni, nj = len(model.tables[i]), len(model.tables[j])
        return np.bincount(b[:, i] * nj + b[:, j], v, ni * nj).reshape(ni, nj)

    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            found.append((_quadrants(sums(i, j, y - q), sums(i, j, q * (1 - q)), ridge)[0], i, j))
    for _, i, j in sorted(found, reverse=True)[:pairs]:
        model.pairs.append((i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))))
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            q = 1 / (1 + np.exp(-raw))
            g, h = sums(i, j, y - q), sums(i, j, q * (1 - q))
            gain, r, c = _quadrants(g, h, ridge)
            if gain <= 1e-9:
                continue
            step = np.empty_like(table)
            for rows in (slice(0, r), slice(r, None)):
                for cols in (slice(0, c), slice(c, None)):
                    step[rows, cols] = rate * g[rows, cols].sum() / (h[rows, cols].sum() + ridge)
            table += step
            raw += step[b[:, i], b[:, j]]
    return model


def _features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(parts, 1):
        x = [np.array(features_of(t or b"")).astype("<f8").tobytes() for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary())], names=["id", "x"])


def train(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train_rows: int) -> Gam:
    """Learns from about ``train_rows`` labelled rows at most that are not held out, chosen by a hash of the id."""
    own = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col, 5, 0))
    n = own.count()
    chosen = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20)) < F.lit(min(1.0, train_rows / max(n, 1)) * (1 << 20))
    picked = df.where(F.col(id_col).isNotNull() & chosen & ~held_out(id_col, 5, 0)).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    # One row for each id, with partial sums, so that the sample is bounded and the join even, however often an id is repeated.
    x = picked.mapInArrow(_features, f"id {df.schema[id_col].dataType.simpleString()}, x binary").groupBy("id").agg(F.min("x").alias("x"))
    y = own.where(chosen).groupBy(F.col(id_col).alias("id")).agg(F.avg(F.col(label_col).cast("int")).alias("y"))
    rows = x.join(y, "id").select("x", "y").collect()
    rows = sorted((bytes(r["x"]), r["y"]) for r in rows)
    if not rows:
        return Gam([np.zeros(0)] * len(FEATURES), 0.0)
    return fit(np.frombuffer(b"".join(r[0] for r in rows), "<f8").reshape(len(rows), -1), np.array([r[1] for r in rows], dtype=float))


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = 20_000, cut: float = 0.3) -> DataFrame:
    """id, held_out, score (probability of label 1), predicted."""
    model = df.sparkSession.sparkContext.broadcast(train(df, labels, id_col, text_col, label_col, train_rows))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(parts, 2):
            x = np.array([features_of(t or b"") for t in b.column(2).to_pylist()], dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(model.value.score(x), pa.float64())], names=["id", "held_out", "score"])

    picked = df.select(F.col(id_col).alias("id"), held_out(id_col, 5, 0).alias("held_out"), F.col(text_col).cast("binary").alias("t"))
    out = picked.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"))
