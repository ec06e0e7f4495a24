"""Mergeable co-moments: counts, means, squares and products of column pairs in one pass.

A task folds its Arrow batches into four k x k matrices over the rows where both columns of a pair
are present, and the matrices are merged in a tree (pairwise update of means and central moments, as
for variances).  So one matrix a task moves, whatever the number of rows, and nothing is expanded by
pairs.  Values are centred by batch before they are multiplied: large means lose no digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import ship_package

#: n, mean of i, sum of squares of i about its mean, sum of products: [i, j] over the rows that have both.
Moments = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def batch_moments(x: np.ndarray, present: np.ndarray) -> Moments:
    """Of a (rows, columns) array and where it has values."""
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        m = present.astype(np.float64)
        count = m.sum(axis=0)
        centre = np.where(count > 0, np.where(present, x, 0.0).sum(axis=0) / count, 0.0)
        d = np.where(present, x - centre, 0.0)
        n, s = m.T @ m, d.T @ m
        mean = np.where(n > 0, s / n, 0.0)
        return n, np.where(n > 0, centre[:, None] + mean, 0.0), (d * d).T @ m - s * mean, d.T @ d - s * mean.T


def merged(a: Moments, b: Moments) -> Moments:
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        n = a[0] + b[0]
        share = np.where(n > 0, b[0] / n, 0.0)
        d = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
        mean = np.where(a[0] > 0, a[1] + d * share, b[1])
        between = np.where(n > 0, a[0] * share, 0.0)
        return n, mean, a[2] + b[2] + d * d * between, a[3] + b[3] + d * d.T * between


def co_moments(df: DataFrame, columns: list[str]) -> Moments:
    """Moments of all pairs of ``columns``; nulls are absent values, NaN is a value."""
    k = len(columns)
    ship_package(df.sparkSession)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = tuple(np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            if batch.num_rows:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(np.float64)
                present = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                total = merged(total, batch_moments(x, present))
        yield pa.RecordBatch.from_arrays([pa.array([np.stack(total).tobytes()], pa.binary())], ["moments"])

    parts = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]).mapInArrow(fold, "moments binary").rdd
    if not parts.getNumPartitions():
        return tuple(np.zeros((k, k)) for _ in range(4))
    return parts.map(lambda r: tuple(np.frombuffer(r["moments"]).reshape(4, k, k))).treeReduce(merged)


def correlations(df: DataFrame, columns: list[str]) -> list[tuple[str, str, float | None]]:
    """(x, y, Pearson correlation) of all pairs; null where either is constant or has fewer than two rows."""
    n, _, squares, products = co_moments(df, columns)
    out = []
    for i, x in enumerate(columns):
        for j, y in enumerate(columns):
            a, b = float(squares[i, j]), float(squares[j, i])
            if n[i, j] < 2 or a == 0 or b == 0:
                out.append((x, y, None))
            else:
                out.append((x, y, 1.0 if i == j and a > 0 else float(products[i, j]) / (a ** 0.5 * b ** 0.5)))
    return out
