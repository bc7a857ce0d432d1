"""Embedding whitening on exact sums.

Method. Components become whole numbers x. One pass adds up every dimension exactly; a second adds
up the products of the numbers less the nearest whole number to their mean, which are small, so
nothing cancels; the fraction of the mean that is left is taken off the sums. The covariance, at
most MOST_COLUMNS squared, goes to the driver, where Householder reflections make it tridiagonal,
Sturm counts bisect its leading eigenvalues and inverse iteration with reorthogonalisation inside
clusters finds the eigenvectors (`eigen`). The projection travels with the tasks. A third pass
measures the covariance of what comes out, and the last one returns it.

A task sends one number per entry of its sums, whatever its rows; entries are added up by key.

Rows whose vector is null or holds null, NaN or infinite components are left out. Vectors shorter
than the longest, empty ones as well, count as padded with zeros. Rows that repeat a vec_id and rows without one are
vectors like others. Directions without variance (eigenvalue not above rounding) cannot be brought
to variance 1 and are no components, so equal vectors alone give no rows; one or few vectors give fewer
components. A deviation beyond 64 bits is null. Components whose whole number reaches 2^40, and
vectors of more than MOST_COLUMNS components, are an error. Other columns are not read. No rows in,
no rows out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .centroids import usable
from .eigen import leading_eigenpairs
from .work import ready

MOST_COLUMNS = 2048
_LARGEST = 1 << 40


def _numbers(batch: pa.RecordBatch, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, a row per vector."""
    given = batch["embedding"]
    flat = np.floor(given.flatten().to_numpy(zero_copy_only=False) * float(scale))
    if len(flat) and np.abs(flat).max() >= _LARGEST:
        raise ValueError(f"a component times {scale} reaches 2^40")
    sizes = given.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.astype(np.int64).reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _sums(width: int, scale: int):
    """Per task: the rows (column -1) and the sum of every column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 1, np.int64)
        for batch in batches:
            numbers = _numbers(batch, width, scale)
            total[0] += len(numbers)
            total[1:] += numbers.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width, dtype=np.int32)), pa.array(total)],
                                         ["i", "total"])
    return run


def _products(width: int, values: Callable[[pa.RecordBatch], np.ndarray]):
    """Per task: sums of products of every two columns of `values`, i <= j."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = values(batch)
            total += rows.T @ rows
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          pa.array(total[i, j])], ["i", "j", "total"])
    return run


def _second_moments(kept: DataFrame, width: int, values: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    sums = (kept.select("embedding").mapInArrow(_products(width, values), "i int, j int, total double")
            .groupBy("i", "j").agg(F.sum("total").alias("total")).toArrow())  # MOST_COLUMNS squared at most
    out = np.zeros((width, width))
    i, j = (sums[c].to_numpy() for c in ("i", "j"))
    out[i, j] = out[j, i] = sums["total"].to_numpy()
    return out


def deviations(numbers: np.ndarray, rest: list[int], n: int) -> list[int | None]:
    """Per row, the sum of (n * x - rest)^2 in exact arithmetic; null beyond 64 bits."""
    largest = max(int(np.abs(numbers).max(initial=0)), 1)
    if largest * max(largest, *map(abs, rest)) * len(rest) >= 1 << 62:
        numbers = numbers.astype(object)
    offsets = np.array(rest, numbers.dtype)
    squares, mixed = (numbers * numbers).sum(axis=1), numbers @ offsets
    last = sum(r * r for r in rest)
    found = [n * n * int(s) - 2 * n * int(m) + last for s, m in zip(squares.tolist(), mixed.tolist())]
    return [f if f < 1 << 63 else None for f in found]


def whiten(vectors: DataFrame, count: int = 32, scale: int = 64) -> DataFrame:
    """vectors(vec_id, embedding) → (vec_id, component, n, deviation, whitened, explained,
    identity_error), one row per usable vector and component 1 to `count`.

    x is floor(scale * component). `whitened` is x less its mean, projected on the unit eigenvector
    of x's covariance V with the component-th largest eigenvalue e, over sqrt(e); `explained` is
    e / trace(V); `deviation` is the exact sum of (n * x - S)^2 over the dimensions, S their sums;
    `identity_error` is the largest absolute entry of the covariance of `whitened` less the identity.
    """
    if count < 1 or scale < 1 or scale & (scale - 1):
        raise ValueError("count must be positive and the scale a power of two")
    ready(vectors.sparkSession)
    kept = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
            .where(usable("embedding")))
    width = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    if width > MOST_COLUMNS:
        raise ValueError(f"vectors have at most {MOST_COLUMNS} components, not {width}")
    totals = (kept.select("embedding").mapInArrow(_sums(width, scale), "i int, total long").groupBy("i")
              .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect() if width else [])
    sums = {r["i"]: int(r["total"]) for r in totals}  # a row per column
    n = sums.pop(-1, 0)
    middle = [(2 * sums[i] + n) // (2 * n) if n else 0 for i in range(width)]
    rest = [sums[i] - n * middle[i] if n else 0 for i in range(width)]
    about, fraction = np.array(middle, np.int64), np.array(rest, np.float64) / max(n, 1)

    def near(batch: pa.RecordBatch) -> np.ndarray:
        """Numbers less the whole number nearest to their mean."""
        return _numbers(batch, width, scale) - about

    if n:
        covariance = (_second_moments(kept, width, lambda b: near(b).astype(np.float64)) / n
                      - np.outer(fraction, fraction))
        values, axes = leading_eigenpairs(covariance, count)
        trace = float(covariance.trace())
        real = values > width * np.finfo(np.float64).eps * max(trace, 0.0)
        values, axes = values[real], axes[:, real]
    else:
        values, axes, trace = np.empty(0), np.empty((width, 0)), 1.0
    if not len(values):
        return kept.where(F.lit(False)).select(
            "vec_id", F.lit(0).alias("component"), F.lit(n).cast("long").alias("n"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in
              (("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))])
    projection = axes / np.sqrt(values)

    def whitened(batch: pa.RecordBatch) -> np.ndarray:
        return (near(batch) - fraction) @ projection

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = near(batch)
            found = (numbers - fraction) @ projection
            offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(deviations(numbers, rest, n), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))],
                ["vec_id", "deviation", "whitened"])

    moments = _second_moments(kept, len(values), whitened) / n
    error = float(np.abs(moments - np.eye(len(values))).max())
    shares = F.array(*[F.lit(float(v / trace)) for v in values])
    return (kept.mapInArrow(rows, "vec_id long, deviation long, whitened array<double>")
            .select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
            .select("vec_id", (F.col("place") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
                    "deviation", "whitened", F.get(shares, F.col("place")).alias("explained"),
                    F.lit(error).alias("identity_error")))
