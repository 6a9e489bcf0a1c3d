"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn on one feature after another, then on pairs of features; each tree's steps are added
to that feature's (or pair's) lookup table over bins. A text's score is the logistic of an intercept plus one table
entry a feature and a pair, so scoring is a few vectorised bin additions.

Fitted on at most ``max_rows`` labelled ids (documented sample: those of least ``xxhash64(doc_id)``), so the driver
holds a table of that many rows and ``len(FEATURES)`` columns whatever the corpus; all rows are scored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ("log_chars", "log_words", "word_length", "longest_word", "upper", "digit", "space", "other_ascii", "symbols", "exclamation", "pipes", "stops", "non_ascii", "distinct_words", "commonest_word", "caps_words", "repeated_lines", "line_length", "packed")
MAX_ROWS = 20_000


def text_features(text: str | None) -> list[float]:
    """Numbers of a whole text; labels, language, source and id are not among them. Null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    m = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    letters, digits, spaces = int(c[65:91].sum() + c[97:123].sum()), int(c[48:58].sum()), int(c[9:14].sum() + c[32])
    return [
        np.log1p(len(raw)), np.log1p(len(words)), sum(map(len, words)) / m, np.log1p(max(map(len, counts), default=0)),
        c[65:91].sum() / max(1, letters), digits / n, spaces / n, (c[:128].sum() - letters - digits - spaces) / n, c[[35, 36, 37, 38, 42, 64, 94, 126]].sum() / m,
        c[33] / m, c[[124, 9]].sum() / m, c[[46, 44, 59, 58]].sum() / m, c[128:].sum() / n, len(counts) / m, max(counts.values(), default=0) / m,
        sum(k for w, k in counts.items() if len(w) > 1 and w.isupper()) / m, 1 - len(set(lines)) / max(1, len(lines)), np.log1p(len(raw) / max(1, len(lines))), len(zlib.compress(raw, 1)) / n,
    ]


def feature_matrix(texts) -> np.ndarray:
    return np.array([text_features(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, l2: float) -> np.ndarray:
    """Steps of a shallow tree over ordered bins, or over a grid of them, split greedily by gain."""
    gain = lambda g, h: g * g / (h + l2)

    def best(box):
        g, h = grad[box], hess[box]
        found = (1e-9, None)
        for axis in range(g.ndim):
            if g.shape[axis] < 2:
                continue
            other = tuple(i for i in range(g.ndim) if i != axis)
            left_g, left_h = np.cumsum(g.sum(axis=other))[:-1], np.cumsum(h.sum(axis=other))[:-1]
            x = gain(left_g, left_h) + gain(g.sum() - left_g, h.sum() - left_h) - gain(g.sum(), h.sum())
            x[(left_h < 0.5) | (h.sum() - left_h < 0.5)] = 0
            if x.max() > found[0]:
                found = (x.max(), (axis, int(x.argmax()) + 1))
        return found

    boxes = [tuple(slice(0, n) for n in grad.shape)]
    while len(boxes) < leaves:
        value, cut, k = max(((*best(b), i) for i, b in enumerate(boxes)), key=lambda x: x[0])
        if cut is None:
            break
        box, (axis, at) = boxes.pop(k), cut
        s = box[axis]
        for part in (slice(s.start, s.start + at), slice(s.start + at, s.stop)):
            boxes.append((*box[:axis], part, *box[axis + 1 :]))
    steps = np.zeros(grad.shape)
    for b in boxes:
        steps[b] = grad[b].sum() / (hess[b].sum() + l2)
    return steps


@dataclass
class AdditiveModel:
    intercept: float = 0.0
    cuts: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)  # (i, j, coarse cuts of i, of j, table)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(self.cuts)]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for t, b in zip(self.tables, self.bins(x), strict=True):
            z += t[b]
        for i, j, ci, cj, t in self.pairs:
            z += t[np.searchsorted(ci, x[:, i], side="right"), np.searchsorted(cj, x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, n_pairs: int = 8, bins: int = 48, coarse: int = 10, rate: float = 0.08, leaves: int = 4, l2: float = 2.0) -> AdditiveModel:
    """Cyclic boosting of one-feature trees, then of the ``n_pairs`` pairs whose first tree gains most. No rows: 0.5 for all."""
    quantile_cuts = lambda v, n: np.unique(np.quantile(v, np.arange(1, n) / n)) if len(v) else np.empty(0)
    model = AdditiveModel(cuts=[quantile_cuts(x[:, i], bins) for i in range(x.shape[1])])
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    if not len(y):
        return model
    model.intercept = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    z = np.full(len(y), model.intercept)
    p = lambda: 1 / (1 + np.exp(-z))
    binned = model.bins(x)
    for _ in range(rounds):
        for b, t in zip(binned, model.tables, strict=True):
            q = p()
            step = rate * _tree(np.bincount(b, y - q, len(t)), np.bincount(b, q * (1 - q), len(t)), leaves, l2)
            t += step
            z += step[b]
    rough = [quantile_cuts(x[:, i], coarse) for i in range(x.shape[1])]
    grid = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(rough)]
    q = p()

    def sums(i, j, q):
        shape = (len(rough[i]) + 1, len(rough[j]) + 1)
        k = grid[i] * shape[1] + grid[j]
        n = shape[0] * shape[1]
        return k, np.bincount(k, y - q, n).reshape(shape), np.bincount(k, q * (1 - q), n).reshape(shape)

    ranked = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            _, g, h = sums(i, j, q)
            s = _tree(g, h, leaves, l2)
            ranked.append((float((s * g - s * s * h / 2).sum()), i, j))
    for _, i, j in sorted(ranked, reverse=True)[:n_pairs]:
        model.pairs.append((i, j, rough[i], rough[j], np.zeros((len(rough[i]) + 1, len(rough[j]) + 1))))
    for _ in range(pair_rounds):
        for i, j, _, _, t in model.pairs:
            k, g, h = sums(i, j, p())
            step = rate * _tree(g, h, leaves, l2)
            t += step
            z += step.ravel()[k]
    return model


def held_out(doc_id="doc_id"):
    """Whether crc32 of the id as text leaves remainder 0 by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = feature_matrix(t.as_py() for t in b.column(2))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS, **params) -> AdditiveModel:
    """Fit on labelled rows that are not held out. Null labels are left out; of several labels of an id the least
    counts, and of several texts of an id the one with the least features."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min(label_col).cast("long").alias("y"))
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # at most max_rows pairs of longs: this bounds the broadcast
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text").mapInArrow(_features, "doc_id long, y long, x array<double>")
    # One row a label, in one order, so that sums of floats are the same in every run.
    x = x.groupBy("doc_id").agg(F.min(F.struct("y", "x")).alias("r")).select("doc_id", "r.*").toPandas().sort_values("doc_id")
    return fit(np.array(x["x"].tolist(), np.float64).reshape(-1, len(FEATURES)), x["y"].to_numpy(np.float64), **params)


def score(docs: DataFrame, model: AdditiveModel, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; null and empty texts are scored as empty. Ties at the threshold count as 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(feature_matrix(t.as_py() for t in b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double").select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: AdditiveModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns as they are."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(feature_matrix(t.as_py() for t in b.column(at))) >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
