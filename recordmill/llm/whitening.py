"""Whitening of vectors by exact covariances through polarisation.

Components become whole numbers x. Over the fit list (each distinct x vector once, n of them with
sums S per dimension) only squares are added up: (n*x_i - S_i)^2 for every dimension and
(n*x_i + n*x_j - S_i - S_j)^2 for every pair of dimensions, as whole numbers without rounding.
Half the difference of such sums is the covariance of a pair times n^3. The matrix, of the
vectors' dimension and not of their number, is rounded once to doubles and given to eigh on the
driver; the components are broadcast with it and every row is projected in its task.

Nulls, ties, repeats: a row whose vector is null, empty or holds null or non-finite entries, or
one beyond 2^56 (no long holds its x), is dropped. Vectors must share one dimension: the most
frequent (of ties the largest) is taken, others are dropped. Repeated rows are rows of their own
but count once in the fit; a null id stays null. A component without variance (e under the
rounding error of eigh) has whitened null; with no variance at all ``explained`` and
``identity_error`` are null too. A deviation beyond a long is null. An empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import short_batches
from recordmill.session import cut_lineage

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 56)
LIMB, LIMBS = 40, 8  # sums travel as digits of 40 bits, so that up to 2^23 tasks can be added as longs
FEW = 1 << 62


class Fit(NamedTuple):
    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # by column, in that order


def quantise(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part, all of one dimension."""
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST)
    rows = embeddings.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda c: F.coalesce(usable(c), F.lit(False))))
    x = F.transform("embedding", lambda c: F.floor(F.lit(SCALE) * c.cast("double")) + F.lit(SHIFT).cast("long"))
    rows = rows.select("vec_id", x.alias("x"))
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (size["d"] if size else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index("x"))
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, as longs where they hold it, else as Python numbers."""
    if x.size and n * max(abs(int(x.min())), abs(int(x.max())), 1) * 2 >= FEW:
        return x.astype(object) * n - np.array(sums, object)
    return x * n - np.array(sums, np.int64)


def square_sums(t: np.ndarray) -> list[int]:
    """The sum of squares of each column, exactly."""
    if not len(t):
        return [0] * t.shape[1]
    largest = int(np.abs(t).max())
    if t.dtype == object or largest >= FEW:
        return [int(v) for v in (t.astype(object) ** 2).sum(axis=0)]
    if largest * largest * len(t) < FEW:
        return (t * t).sum(axis=0).tolist()
    a, b, c = t >> 42, (t >> 21) & 0x1FFFFF, t & 0x1FFFFF  # |a| < 2^20, others < 2^21: 2^20 rows can be added
    parts = [(p * q).sum(axis=0).tolist() for p, q in ((a, a), (a, b), (b, b), (a, c), (b, c), (c, c))]
    return [(aa << 84) + (ab << 64) + (bb << 42) + (ac << 43) + (bc << 22) + cc for aa, ab, bb, ac, bc, cc in zip(*parts)]


def _pair_squares(y: np.ndarray) -> list[int]:
    """Squares of every dimension, then of the sum of every pair (0,1), (0,2), ..."""
    told = square_sums(y)
    for i in range(y.shape[1] - 1):
        told += square_sums(y[:, i : i + 1] + y[:, i + 1 :])
    return told


def _added(rows: DataFrame, of: Callable[[np.ndarray], list[int]]) -> list[int]:
    """Whole numbers of each batch of x, added over all rows without rounding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            if len(batch):
                more = of(_matrix(batch))
                total = [a + b for a, b in zip(total, more)] if total else more
        if total:
            digit = (1 << LIMB) - 1
            limbs = [[v >> (LIMB * k) if k == LIMBS - 1 else (v >> (LIMB * k)) & digit for v in total] for k in range(LIMBS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), *[pa.array(p, pa.int64()) for p in limbs]], ["item", *[f"d{k}" for k in range(LIMBS)]])

    names = [f"d{k}" for k in range(LIMBS)]
    digits = rows.mapInArrow(run, "item int, " + ", ".join(f"{d} long" for d in names))
    added = digits.groupBy("item").agg(*[F.sum(d).alias(d) for d in names]).collect()
    return [sum(row[d] << (LIMB * k) for k, d in enumerate(names)) for row in sorted(added)]


def fit(rows: DataFrame) -> Fit | None:
    """Exact sums over distinct (x) rows, and the components; None without rows. What comes to the driver has the size of the matrix."""
    n = rows.count()
    if not n:
        return None
    sums = _added(rows, lambda x: [int(v) for v in (x.astype(object) if np.abs(x).max() >= FEW // max(len(x), 1) else x).sum(axis=0)])
    d = len(sums)
    squares = _added(rows, lambda x: _pair_squares(centred(x, n, sums)))
    covariance = np.zeros((d, d))
    pairs = iter(squares[d:])
    for i in range(d):
        covariance[i, i] = squares[i] / n**3
        for j in range(i + 1, d):
            covariance[i, j] = covariance[j, i] = (next(pairs) - squares[i] - squares[j]) / (2 * n**3)
    values, vectors = np.linalg.eigh(covariance)
    return Fit(n, sums, covariance, values[::-1].copy(), vectors[:, ::-1].copy())


def _projector(model: Fit, components: int) -> np.ndarray:
    """Matrix of the components over the root of their variance; a column without variance is NaN."""
    d = len(model.sums)
    k = min(components, d)
    seen = model.values[:k] > max(model.values[0], 0.0) * d * np.finfo(float).eps
    return model.vectors[:, :k] / np.sqrt(np.where(seen, model.values[:k], np.nan))


def _float_sums(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(of(_matrix(batch)) for batch in batches if len(batch))
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel(), pa.float64())], ["item", "v"])

    return np.array([row["s"] for row in sorted(rows.mapInArrow(run, "item int, v double").groupBy("item").agg(F.sum("v").alias("s")).collect())])


def identity_error(rows: DataFrame, model: Fit, components: int) -> float | None:
    """Largest absolute entry of the whitened rows' covariance less the identity, taken from the rows, centred first."""
    n, sums, turn = model.n, model.sums, _projector(model, components)
    turn = turn[:, ~np.isnan(turn).any(axis=0)]
    if not turn.shape[1]:
        return None
    whitened = lambda x: centred(x, n, sums).astype(float) / n @ turn
    mean = _float_sums(rows, lambda x: whitened(x).sum(axis=0)) / n
    products = _float_sums(rows, lambda x: (whitened(x) - mean).T @ (whitened(x) - mean)) / n
    k = turn.shape[1]
    return float(np.abs(products.reshape(k, k) - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every row and component."""
    spark = embeddings.sparkSession
    short_batches(spark)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = quantise(embeddings)
    distinct = cut_lineage(rows.select("x").distinct())
    model = fit(distinct)
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(distinct, model, components)
    n, sums, turn, trace = model.n, model.sums, _projector(model, components), float(np.trace(model.covariance))
    k = turn.shape[1]
    share = np.array([max(v, 0.0) / trace if trace > 0 else np.nan for v in model.values[:k]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            y = centred(_matrix(batch), n, sums)
            whitened = (y.astype(float) / n) @ turn
            deviations = [v if v < 1 << 63 else None for v in square_sums(np.ascontiguousarray(y.T))]
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            each = np.repeat(np.arange(len(batch)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(each)).cast(pa.int64()),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(batch))),
                    pa.array(np.full(len(each), n, np.int64)),
                    pa.array(deviations, pa.int64()).take(pa.array(each)),
                    pa.array(whitened.ravel(), pa.float64(), from_pandas=True),
                    pa.array(np.tile(share, len(batch)), pa.float64(), from_pandas=True),
                    pa.array([error] * len(each), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
