"""The inverted multi-index: independent codebooks on the two halves of a vector.

A pair of codewords, one of each half, is a cell of the product grid. The grid itself is
small and travels with the tasks; vectors are dealt to cells by Spark.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Vectors that a codebook is fitted on, about; every vector is indexed.
FIT_ROWS = 8192
FIT_STEPS = 12
SEED = 20260301


@dataclass(frozen=True)
class Grid:
    """Codewords of both halves; the first half has ``cut`` components."""

    cut: int
    left: np.ndarray
    right: np.ndarray

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.left), len(self.right)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.cut], x[:, self.cut :]

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of each row's halves from all codewords of that half."""
        return tuple(_squares(h, c) for h, c in zip(self.halves(x), (self.left, self.right), strict=True))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest codeword of each half."""
        left, right = self.distances(x)
        return left.argmin(1), right.argmin(1)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(
        0.0, (x * x).sum(1)[:, None] - 2.0 * (x @ centres.T) + (centres * centres).sum(1)[None, :]
    )


def _codebook(x: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """At most ``count`` means of the rows."""
    different = np.unique(x, axis=0)
    centres = different[rng.permutation(len(different))[:count]].copy()
    for _ in range(FIT_STEPS):
        nearest = _squares(x, centres).argmin(1)
        held = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres[held > 0] = sums[held > 0] / held[held > 0, None]
    return centres


def fit(sample: np.ndarray, count: int, seed: int = SEED) -> Grid:
    """Codebooks of at most ``count`` words on each half, fitted on sample rows."""
    rng = np.random.default_rng(seed)
    cut = sample.shape[1] // 2
    return Grid(cut, _codebook(sample[:, :cut], count, rng), _codebook(sample[:, cut:], count, rng))


def sample_of(vectors: DataFrame, rows: int, key: Column, column: str) -> np.ndarray:
    """About ``FIT_ROWS`` vectors chosen by a hash of ``key``, of a table with ``rows`` rows."""
    share = min(1.0, FIT_ROWS / max(1, rows))
    few = vectors.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = [row[0] for row in few.select(column).collect()]
    if not found:
        found = [row[0] for row in vectors.select(column).limit(1).collect()]
    return np.array(found, np.float64)


def multi_sequence(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """Cells ``(i, j)`` by rising ``left[i] + right[j]``.

    A heap holds the next cell of each sorted row that was opened; a row opens when the
    first cell of the one before it was visited.
    """
    rows, columns = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    a, b = left[rows].tolist(), right[columns].tolist()
    rows, columns = rows.tolist(), columns.tolist()
    heap = [(a[0] + b[0], 0, 0)]
    while heap:
        cost, i, j = heapq.heappop(heap)
        yield rows[i], columns[j], cost
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~bad, F.lit(False))


def usual_length(vectors: DataFrame, column: str) -> tuple[int, int]:
    """The most frequent length of a vector, the longer of two, and how many have it."""
    lengths = vectors.groupBy(F.size(column).alias("length")).agg(F.count("*").alias("n"))
    row = lengths.filter("length > 0").orderBy(F.desc("n"), F.desc("length")).first()
    return (0, 0) if row is None else (row["length"], row["n"])
