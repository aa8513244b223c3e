"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are numbers of its make-up (lengths, shares of kinds of characters, repeated lines, ...). Each has a
lookup table over quantile bins. Cyclic boosting visits the features in turn, round after round, and adds a shallow
tree (at most ``leaves`` leaves, over one feature's bins) fitted to the present residuals at a small rate. Then the
strongest pairs are found on the residuals and boosted the same way over coarser two-way bins. A text's score is the
logistic of the sum of its bins' values: vectorised look-ups and additions.

Learning takes a bounded sample of labelled rows (``max_labels``, those with the smallest hashes of their id), which is
the one thing that is fitted on the driver. Features and scores cover every whole text, inside Spark's tasks.

Nulls and edges: a null text is scored as an empty one; rows with a null label or id teach nothing; an id with several
labels teaches each; with no labels, or labels of one kind, the score is the smoothed share of ones (0.5 with none).
Ties in the sample's hash are broken by id and label. Extra columns are ignored by ``score`` and kept by
``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

FEATURES = (
    "log_words", "word_length", "symbols", "upper", "exclamations", "bars", "digits", "repeated_lines", "different_words",
    "stopped_lines", "short_words", "punctuation", "beyond_ascii", "log_line", "odd_words", "long_words",
)

_KINDS = {
    "symbols": b"#*$%&<>@^~\\_={}[]", "bars": b"|", "exclamations": b"!?", "digits": b"0123456789", "punctuation": b".,;:'\"()-/",
}
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_EDGE = b".,;:!?'\"()-"


def features(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = max(len(words), 1), max(sum(map(len, words)), 1)
    count = lambda kinds: len(raw) - len(raw.translate(None, kinds))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(count(_LETTERS), 1)
    different = set(words)
    odd = sum(1 for w in different if w.strip(_EDGE).translate(None, _LETTERS))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    m = max(len(lines), 1)
    return [
        float(np.log1p(len(words))), size / n, count(_KINDS["symbols"]) / n, count(_UPPER) / letters, count(_KINDS["exclamations"]) / n,
        count(_KINDS["bars"]) / n, count(_KINDS["digits"]) / size, 1 - len(set(lines)) / m, len(different) / n**0.75,
        sum(x.rstrip().endswith(b".") for x in lines) / m, float((lengths <= 3).sum()) / n, count(_KINDS["punctuation"]) / n,
        1 - len(raw.translate(None, bytes(range(128, 256)))) / max(len(raw), 1), float(np.log1p(max(map(len, lines), default=0))), odd / max(len(different), 1), float((lengths > 14).sum()) / n,
    ]


def _leaves(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A shallow tree over the bins of one feature: cut where the gain is largest, leaf by leaf; the values by bin."""
    g, h = np.concatenate(([0.0], grad.cumsum())), np.concatenate(([0.0], hess.cumsum()))
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a > 1:
                cuts = np.arange(a + 1, b)
                won = gain(a, cuts) + gain(cuts, b) - gain(a, b)
                k = int(won.argmax())
                if won[k] > best[0]:
                    best = (float(won[k]), (a, b), int(cuts[k]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out


class Gam:
    def __init__(self, bins: int = 32, pair_bins: int = 8, pairs: int = 6, rounds: int = 120, rate: float = 0.1, leaves: int = 3, ridge: float = 4.0):
        self.bins, self.pair_bins, self.n_pairs, self.rounds, self.rate, self.leaves, self.ridge = bins, pair_bins, pairs, rounds, rate, leaves, ridge

    def _binned(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1) if len(x) else np.zeros((0, len(edges)), np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Gam:
        cut = lambda n: [np.unique(np.quantile(x[:, j], np.arange(1, n) / n)) if len(x) else np.zeros(0) for j in range(len(FEATURES))]
        self.edges, self.coarse, self.pairs, self.pair_tables = cut(self.bins), cut(self.pair_bins), [], []
        self.tables = [np.zeros(self.bins) for _ in FEATURES]
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return self
        b, c = self._binned(x, self.edges), self._binned(x, self.coarse)
        f = np.full(len(y), self.base)

        def boost(index: np.ndarray, size: int, shape: tuple[int, ...]) -> np.ndarray:
            p = 1 / (1 + np.exp(-f))
            grad, hess = np.bincount(index, y - p, size), np.bincount(index, p * (1 - p), size)
            if len(shape) == 1:
                return self.rate * _leaves(grad, hess, self.leaves, self.ridge)
            grad, hess = grad.reshape(shape), hess.reshape(shape)  # two ways: a tree over one, then a tree in each leaf
            rows = _leaves(grad.sum(1), hess.sum(1), 2, self.ridge)
            out = np.zeros(shape)
            for v in np.unique(rows):
                at = rows == v
                out[at] = _leaves(grad[at].sum(0), hess[at].sum(0), 2, self.ridge)
            return self.rate * out.ravel()

        for _ in range(self.rounds):
            for j in range(len(FEATURES)):
                step = boost(b[:, j], self.bins, (self.bins,))
                self.tables[j] += step
                f += step[b[:, j]]
        k, ways = self.pair_bins, [(i, j) for i in range(len(FEATURES)) for j in range(i)]
        p = 1 / (1 + np.exp(-f))

        def strength(i: int, j: int) -> float:
            at = c[:, i] * k + c[:, j]
            g, h = np.bincount(at, y - p, k * k), np.bincount(at, p * (1 - p), k * k)
            return float((g * g / (h + self.ridge)).sum())

        self.pairs = sorted(ways, key=lambda w: (-strength(*w), w))[: self.n_pairs]
        self.pair_tables = [np.zeros(k * k) for _ in self.pairs]
        for _ in range(self.rounds // 2):
            for t, (i, j) in zip(self.pair_tables, self.pairs):
                at = c[:, i] * k + c[:, j]
                step = boost(at, k * k, (k, k))
                t += step
                f += step[at]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        b, c = self._binned(x, self.edges), self._binned(x, self.coarse)
        f = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            f += t[b[:, j]]
        for t, (i, j) in zip(self.pair_tables, self.pairs):
            f += t[c[:, i] * self.pair_bins + c[:, j]]
        return 1 / (1 + np.exp(-f))


def _features_of(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def learn(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000, **settings) -> Gam:
    """Fits on at most max_labels labelled texts: of the labels (doc_id, label) with the smallest hashes of their id,
    joined to all rows of docs with that id, the first ones by hash, id, label and features. So repeated ids neither
    lift the bound nor make the choice depend on the order of tasks."""
    rows = labels.filter("doc_id is not null and label is not null").select(F.col("doc_id").cast("long"), F.col("label").cast("int").alias("label"))
    sample = rows.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id", "label").limit(max_labels)
    known = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id")  # at most max_labels rows of two numbers

    def made(batches):
        for batch in slices(batches):
            x = _features_of(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(list(x), pa.list_(pa.float64()))], ["label", "h", "doc_id", "x"])

    rows = known.select("text", "label", "h", "doc_id").mapInArrow(made, "label int, h long, doc_id long, x array<double>")
    got = rows.orderBy("h", "doc_id", "label", "x").limit(max_labels).select("label", "x").toArrow()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(got.num_rows, len(FEATURES))
    y = np.array(got.column("label").to_pylist(), np.float64)
    order = np.lexsort((*x.T, y))  # rows come in any order; the fit must not depend on it
    return Gam(**settings).fit(x[order], y[order])


def score(docs: DataFrame, model: Gam) -> DataFrame:
    """(doc_id, score) of every row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size follows from bins and features alone

    def scored(batches):
        for batch in slices(batches):
            s = shared.value.score(_features_of(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Gam, least: float = 0.7) -> DataFrame:
    """The rows of docs, with all their columns, with a score of at least this."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def kept(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array(shared.value.score(_features_of(batch.column(at).to_pylist())) >= least))

    return docs.mapInArrow(kept, docs.schema)
