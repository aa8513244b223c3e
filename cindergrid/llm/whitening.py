"""Whitening of embeddings by the polarisation of variances.

Each entry c becomes the integer x = floor(64 c) + 1,000,000. One pass sums x by dimension. A second pass centres x by
the integer part of its mean and sums exact squares for every dimension and for every sum of two dimensions; with the
means' remainders these are the squares of (n x - S) exactly, and

    covariance(i, j) = (variance(i + j) - variance(i) - variance(j)) / 2

gives all cross-covariances, in whole numbers until the last division. The matrix, of a size that the vectors' length
alone decides, goes through ``eigh``; a third pass scores every row. What a task holds is one batch of rows and one sum
for each pair of dimensions.

Nulls and edges: rows whose vector is null, or has a null or non-finite entry, are dropped, as are those that are not
as long as most (the longer of two equally frequent lengths counts). Repeated rows and null ids count and stay. Components
without variance cannot be scaled to one, so there are no rows for them; without rows, or with equal rows only, the result
is empty. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
ROWS = 2048
WIDE = pa.decimal128(38)


@dataclass
class Model:
    """n rows, sums by dimension, unit components as columns by falling variance, their variances, the total variance,
    and, once measured, how far the whitened covariance is from the identity."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0


def usable(vector: str | Column) -> Column:
    """Whether a vector is there and all its entries are finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    fault = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, fault), F.lit(False))


def clean(rows: DataFrame) -> DataFrame:
    """(vec_id, v: array of doubles) of the usable rows of the commonest length."""
    good = rows.filter(usable("embedding")).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    lengths = good.filter(F.size("v") > 0).groupBy(F.size("v").alias("d")).count().agg(F.max(F.struct("count", "d"))["d"]).first()[0]
    return good.filter(F.size("v") == (lengths or -1))


def _integers(batch: pa.RecordBatch):
    """Blocks of rows of a batch: their place in it, and x as an integer matrix."""
    for a in range(0, batch.num_rows, ROWS):
        part = batch.slice(a, ROWS).column("v")
        c = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
        yield a, np.floor(SCALE * c).astype(np.int64) + SHIFT


def _exact(a: np.ndarray, bound: int) -> np.ndarray:
    """a, as Python's integers where results up to the bound do not fit into 64 bits."""
    return a if bound < 1 << 62 else a.astype(object)


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the sum of x in each dimension."""

    def made(batches):
        n, total = 0, 0
        for batch in batches:
            for _, x in _integers(batch):
                n += len(x)
                total = total + _exact(x, int(np.abs(x).max()) * len(x)).sum(axis=0).astype(object)
        if n:
            values = [n, *total]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(values) - 1), pa.int32()), pa.array(map(Decimal, values), WIDE)], ["i", "s"])

    found = rows.select("v").mapInArrow(made, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()  # a row for each dimension
    by = {r.i: int(r.s) for r in found}
    return by.pop(-1, 0), [by[i] for i in sorted(by)]


def _squares(rows: DataFrame, centre: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums of squares of x - centre, in each dimension (i, i), and of the sum of two of them (i, j)."""
    d, at = len(centre), np.array(centre, np.int64)

    def made(batches):
        total = [0] * (d * (d + 1) // 2)
        for batch in batches:
            for _, x in _integers(batch):
                z, found = x - at, []
                z = _exact(z, (2 * int(np.abs(z).max())) ** 2 * len(z))
                for i in range(d):
                    w = z[:, i + 1 :] + z[:, i : i + 1]
                    found += [(z[:, i] * z[:, i]).sum(), *(w * w).sum(axis=0)]
                total = [a + int(b) for a, b in zip(total, found)]
        if any(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(map(Decimal, total), WIDE)], ["k", "s"])

    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    found = rows.select("v").mapInArrow(made, "k int, s decimal(38,0)").groupBy("k").agg(F.sum("s").alias("s")).collect()  # a row for each pair of dimensions
    return dict.fromkeys(pairs, 0) | {pairs[r.k]: int(r.s) for r in found}


def fit(rows: DataFrame, components: int = 32) -> Model | None:
    """The model of clean rows; None where nothing varies."""
    n, sums = _sums(rows)
    if not n:
        return None
    squares, left = _squares(rows, [s // n for s in sums]), [s % n for s in sums]
    # sum over rows of (n x - S)^2, and of the same for sums of two dimensions
    power = {(i, j): n * n * q - n * (left[i] + left[j] * (i != j)) ** 2 for (i, j), q in squares.items()}
    v = np.zeros((len(sums), len(sums)))
    for (i, j), p in power.items():
        v[i, j] = v[j, i] = p / n**3 if i == j else (p - power[i, i] - power[j, j]) / (2 * n**3)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(components, int((values > len(values) * np.finfo(float).eps * max(values[0], 0)).sum()))
    trace = sum(power[i, i] for i in range(len(sums))) / n**3
    return Model(n, sums, vectors[:, :keep], values[:keep], trace) if keep else None


def _whitened(x: np.ndarray, model: Model) -> np.ndarray:
    base = np.array([s // model.n for s in model.sums], np.int64)
    rest = np.array([(s % model.n) / model.n for s in model.sums])
    return ((x - base) - rest) @ model.vectors / np.sqrt(model.values)


def measure(rows: DataFrame, model: Model) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k = len(model.values)

    def made(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in _integers(batch):
                w = _whitened(x, model)
                total[:k] += w.T @ w
                total[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["k", "s"])

    found = rows.select("v").mapInArrow(made, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()  # a row for each pair of components
    total = np.array([r.s for r in sorted(found, key=lambda r: r.k)]).reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def score(rows: DataFrame, model: Model | None) -> DataFrame:
    """A row for each clean row and component. deviation: the sum over dimensions of (n x - S)^2."""
    rows = rows.select(F.col("vec_id").cast("long"), "v")
    if model is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    k, n = len(model.values), model.n
    explained = model.values / model.trace

    def made(batches):
        base = np.array([s // n for s in model.sums], np.int64)
        rest = np.array([s % n for s in model.sums], np.int64)
        for batch in batches:
            for a, x in _integers(batch):
                z = x - base
                y = _exact(z, (n * (int(np.abs(z).max()) + 1)) ** 2 * len(model.sums)) * n - rest
                deviation = pa.array([Decimal(int(v)) for v in (y * y).sum(axis=1)], WIDE)
                row, m = np.repeat(np.arange(len(x)), k), len(x) * k
                columns = [
                    batch.column(0).slice(a, ROWS).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(m, n)), deviation.take(pa.array(row)),
                    pa.array(_whitened(x, model).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(m, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(made, RESULT)


def whiten(embeddings: DataFrame, components: int = 32) -> DataFrame:
    """The whitened components of all usable rows of embeddings (vec_id, embedding)."""
    rows = clean(embeddings)
    model = fit(rows, components)
    if model is not None:
        model.identity_error = measure(rows, model)
    return score(rows, model)
