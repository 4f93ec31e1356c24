"""Whitening of vectors by an incremental eigendecomposition.

Every task keeps the mean and the spectrum (eigenvalues and eigenvectors) of the centred
scatter of the rows it has seen. New rows enter by rank-one updates: each solves a
secular equation for the new eigenvalues after deflating components that it does not
change. A batch with more rows than dimensions is first turned by an orthogonal
transform into as many rows as there are dimensions, which have the same scatter. Spectra of
tasks are combined in groups, again by rank-one updates with the scaled eigenvectors of
one side and the difference of the means. At the end the leading directions are refined:
tasks multiply the covariance, centred by the exact mean, with the basis (Rayleigh-Ritz),
and residuals widen the basis until they vanish.

Entries are the integers ``floor(64 * c) + 1000000``; counts, sums and deviations are exact.

Rows: a vector that is null, holds null or non-finite entries, or whose entries do not
fit (2^52 and more) takes no part; neither does one of another length than the most
frequent one (the longer of two). Repeated rows and ids count as often as they are there; a
null id stays a row. Components without variance are left out, so a table of one row or of equal
vectors gives no rows, as does an empty table. A deviation that does not fit a long is
null. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, multi_index

FACTOR, OFFSET = 64, 1_000_000
COMPONENTS = 32
# Rows that enter a spectrum together.
BATCH = 4096
# Spectra or sums that one task combines.
FAN = 16
ROUNDS = 12
EPS = np.finfo(float).eps
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, "
    "explained double, identity_error double"
)


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + z z'`` as offsets from poles.

    ``d`` rises strictly and no ``z`` is zero. Returns ``(gap, roots)``: ``gap[i, j]`` is
    ``d[i]`` less root ``j``, formed from the nearer pole so that no digits are lost. All roots are
    found together: each step fits the sums left and right of a root by one pole each, and steps
    that leave the bracket are replaced by halving it.
    """
    k = len(d)
    square = z * z
    ends = np.append(d[1:], d[-1] + square.sum())
    middle = (d + ends) / 2
    at_middle = 1.0 + (square[:, None] / (d[:, None] - middle)).sum(0)
    # A root left of the middle is measured from its left pole, otherwise from its right one.
    from_left = at_middle >= 0
    from_left[-1] = True
    origin = np.where(from_left, d, ends)
    delta = d[:, None] - origin
    width = ends - d
    low = np.where(from_left, 0.0, -width / 2)
    high = np.where(from_left, width / 2, 0.0)
    if at_middle[-1] < 0:
        low[-1], high[-1] = width[-1] / 2, width[-1]
    t = (low + high) / 2
    left = np.tril(np.ones((k, k), bool)).T
    own, following = d - origin, ends - origin
    for _ in range(100):
        gap = delta - t
        part = square[:, None] / gap
        slope = part / gap
        f = 1.0 + part.sum(0)
        low, high = np.where(f < 0, t, low), np.where(f < 0, high, t)
        to_own, to_next = own - t, following - t
        left_slope = np.where(left, slope, 0.0).sum(0)
        right_slope = slope.sum(0) - left_slope
        s, r = to_own**2 * left_slope, to_next**2 * right_slope
        c = f - to_own * left_slope - to_next * right_slope
        a = c * (to_own + to_next) + s + r
        b = to_own * to_next * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(0.0, a * a - 4.0 * b * c))
            step = np.where(a <= 0, (a - root) / (2.0 * c), 2.0 * b / (a + root))
        new = t + step
        bad = ~np.isfinite(new) | (new <= low) | (new >= high)
        new = np.where(bad, (low + high) / 2, new)
        # As near as the equation can be evaluated, or as the bracket can be cut.
        done = np.abs(f) <= 4 * EPS * (1.0 + np.abs(part).sum(0))
        done |= high - low <= 2 * EPS * np.abs(t)
        t = np.where(done | (new == 0), t, new)
        if done.all():
            break
    return delta - t, origin + t


def rank_one(d: np.ndarray, q: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``q diag(d) q' + u u'``; eigenvalues rise.

    Components that ``u`` does not touch keep their values, and of equal eigenvalues all but
    one are turned out of its way (deflation). The rest solves the secular equation; its
    eigenvectors come from the ``z`` that the roots belong to exactly, so they stay orthogonal.
    """
    z = u @ q
    size = max(float(np.abs(d).max(initial=0.0)), float(z @ z))
    if size == 0.0:
        return d, q
    least = 8 * EPS * size
    touched = np.abs(z) * np.sqrt(float(z @ z)) > least
    close = np.flatnonzero(touched)
    if len(close) > 1 and (np.diff(d[close]) <= least).any():
        q, z = q.copy(), z.copy()
        before = close[0]
        for i in close[1:]:
            if d[i] - d[before] <= least:
                length = np.hypot(z[before], z[i])
                cos, sin = z[i] / length, z[before] / length
                turned = cos * q[:, before] - sin * q[:, i]
                q[:, i] = sin * q[:, before] + cos * q[:, i]
                q[:, before] = turned
                z[before], z[i] = 0.0, length
                touched[before] = False
            before = i
    rest = np.flatnonzero(touched)
    if not len(rest):
        return d, q
    poles, weight = d[rest], z[rest]
    gap, roots = secular_roots(poles, weight)
    ratio = poles[:, None] - poles[None, :]
    np.fill_diagonal(ratio, -1.0)
    # The z whose secular equation has exactly these roots.
    exact = np.sqrt(np.abs(np.prod(gap / ratio, axis=1)))
    w = np.copysign(exact, weight)[:, None] / gap
    w /= np.sqrt((w * w).sum(0))
    values, vectors = d.copy(), q.copy()
    values[rest], vectors[:, rest] = roots, q[:, rest] @ w
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, mean and eigendecomposition of the centred scatter of some rows."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dimension: int) -> Spectrum:
        return cls(0, np.zeros(dimension), np.zeros(dimension), np.eye(dimension))

    def _join(self, n: int, mean: np.ndarray, rows: np.ndarray) -> None:
        """Take in ``n`` rows with a mean and rows of the same centred scatter."""
        both = self.n + n
        away = mean - self.mean
        if self.n:
            rows = np.vstack([rows, away * np.sqrt(self.n * (n / both))])
        for u in rows:
            self.values, self.vectors = rank_one(self.values, self.vectors, u)
        self.mean = self.mean + away * (n / both)
        self.n = both

    def add(self, rows: np.ndarray) -> None:
        mean = rows.mean(0)
        centred = rows - mean
        if len(centred) > centred.shape[1]:
            centred = np.linalg.qr(centred, mode="r")
        self._join(len(rows), mean, centred)

    def merge(self, other: Spectrum) -> None:
        if other.n:
            kept = np.sqrt(np.maximum(0.0, other.values))
            self._join(other.n, other.mean, (other.vectors * kept).T[kept > 0])

    def row(self) -> tuple[int, list[float], list[float], list[float]]:
        # Rounding of many products turns the vectors a little; this sets them upright.
        upright, r = np.linalg.qr(self.vectors)
        upright = upright * np.where(np.diag(r) < 0, -1.0, 1.0)
        return self.n, self.mean.tolist(), self.values.tolist(), upright.ravel().tolist()

    @classmethod
    def of(cls, row) -> Spectrum:
        dimension = len(row["mean"])
        vectors = np.array(row["vectors"], float).reshape(dimension, dimension)
        return cls(int(row["n"]), np.array(row["mean"], float), np.array(row["values"], float), vectors)


def entries(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """``vec_id`` and the integer entries ``x`` of the rows that take part, and their length."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(multi_index.usable("v"))
    rows = rows.filter(~F.exists("v", lambda c: F.abs(c) >= float(1 << 52) / FACTOR))
    dimension, _ = multi_index.usual_length(rows, "v")
    x = F.transform("v", lambda c: F.floor(c * FACTOR) + F.lit(OFFSET).cast("long"))
    return rows.filter(F.size("v") == dimension).select("vec_id", x.alias("x")), dimension


def _matrix(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    return np.array(batch.column("x").flatten(), np.int64).reshape(-1, dimension)


def _stacked(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    """Matrices of up to ``BATCH`` rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(_matrix(batch, dimension))
        rows += len(held[-1])
        if rows >= BATCH:
            yield np.vstack(held)
            held, rows = [], 0
    if rows:
        yield np.vstack(held)


def _exact_sums(x: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _stacked(batches, dimension):
            # Two parts of each number, so that no sum of a batch overflows.
            high, low = (rows >> 32).sum(0), (rows & 0xFFFFFFFF).sum(0)
            yield pa.RecordBatch.from_pydict(
                {
                    "at": pa.array(np.arange(dimension, dtype=np.int32)),
                    "n": pa.array(np.full(dimension, len(rows), np.int64)),
                    "high": pa.array(high),
                    "low": pa.array(low),
                }
            )

    parts = common.mapped(x.select("x"), run, "at int, n long, high long, low long")
    whole = F.sum(F.col("high").cast("decimal(28,0)")).alias("high"), F.sum(F.col("low").cast("decimal(28,0)")).alias("low")
    # One row per dimension.
    found = sorted(parts.groupBy("at").agg(F.sum("n").alias("n"), *whole).collect())
    return (int(found[0]["n"]) if found else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in found]


class Centred:
    """Rows less the exact mean, in double precision."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.base = np.array([s // n for s in sums], np.int64)
        self.over = np.array([s - n * (s // n) for s in sums], np.float64) / n
        self.left = np.array([s - n * (s // n) for s in sums], np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.over

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n * x - S) ** 2``; None where a long is too small."""
        away = x - self.base
        most = int(np.abs(away).max(initial=0)) + 1
        if (most * self.n) ** 2 * max(1, x.shape[1]) < 1 << 63:
            return ((away * self.n - self.left) ** 2).sum(1).tolist()
        n, left = self.n, self.left.astype(object)
        exact = ((away.astype(object) * n - left) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def _fold(parts: DataFrame, combine: Callable[[pd.DataFrame], pd.DataFrame], name: str):
    """One row from rows numbered by ``part``: groups of ``FAN`` are combined until one is left."""
    schema = parts.schema
    while True:
        parts = common.written(parts, name)
        count, most = parts.agg(F.count("*"), F.max("part")).first()
        if count == 0:
            return None
        if count == 1:
            return parts.first()
        last = int(most) // FAN
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        tasks = min(last + 1, int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        parts = parts.repartition(tasks, "part").groupBy("part").applyInPandas(combine, schema)


def spectrum(x: DataFrame, dimension: int) -> Spectrum | None:
    """The spectrum of all rows by rank-one updates in tasks and between them."""
    schema = "n long, mean array<double>, values array<double>, vectors array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(dimension)
        for rows in _stacked(batches, dimension):
            # The constant offset does not change the scatter.
            own.add((rows - OFFSET).astype(np.float64))
        if own.n:
            n, mean, values, vectors = own.row()
            yield pa.RecordBatch.from_pydict(
                {"n": pa.array([n], pa.int64()), "mean": [mean], "values": [values], "vectors": [vectors]}
            )

    def combine(frames: pd.DataFrame) -> pd.DataFrame:
        first, *others = (Spectrum.of(row) for _, row in frames.iterrows())
        for other in others:
            first.merge(other)
        n, mean, values, vectors = first.row()
        return pd.DataFrame(
            {"n": [n], "mean": [mean], "values": [values], "vectors": [vectors], "part": [frames["part"].iloc[0]]}
        )

    parts = common.mapped(x.select("x"), run, schema).withColumn("part", F.spark_partition_id())
    row = _fold(parts, combine, "spectra")
    return None if row is None else Spectrum.of(row.asDict())


def _summed(x: DataFrame, dimension: int, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all rows of a matrix that ``of`` makes from a batch of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for rows in _stacked(batches, dimension):
            made = of(rows)
            total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_pydict({"total": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    def combine(frames: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(frames["total"].to_list()), axis=0)
        return pd.DataFrame({"total": [total.tolist()], "part": [frames["part"].iloc[0]]})

    parts = common.mapped(x.select("x"), run, "total array<double>").withColumn("part", F.spark_partition_id())
    row = _fold(parts, combine, "sums")
    return np.array(row["total"], float).reshape(shape)


def refine(
    x: DataFrame, dimension: int, centred: Centred, basis: np.ndarray, components: int
) -> tuple[np.ndarray, np.ndarray, float]:
    """Leading eigenvalues (falling), their vectors and the trace of the covariance.

    Rayleigh-Ritz: the covariance, applied to the basis by all tasks, is projected on it
    and solved there. While a wanted direction leaves a residual outside the basis, the basis
    grows by it.
    """
    n = centred.n

    for _ in range(ROUNDS):
        basis = np.linalg.qr(basis)[0]
        held = basis

        def product(rows: np.ndarray, held: np.ndarray = held) -> np.ndarray:
            away = centred(rows)
            return np.hstack([(away.T @ (away @ held)), (away * away).sum(0)[:, None]])

        made = _summed(x, dimension, product, (dimension, basis.shape[1] + 1)) / n
        image, trace = made[:, :-1], float(made[:, -1].sum())
        inner = basis.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        wanted = min(components, len(values))
        vectors = basis @ turn
        residual = image @ turn[:, :wanted] - vectors[:, :wanted] * values[:wanted]
        size = np.sqrt((residual * residual).sum(0))
        open_ = size > 16 * EPS * max(trace, 0.0)
        if basis.shape[1] == dimension or not open_.any():
            break
        grown = np.hstack([vectors, residual[:, open_] / size[open_]])
        basis = grown[:, :dimension]
    return values[:wanted], vectors[:, :wanted], trace


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: see the module for what is counted and left out."""
    spark = vectors.sparkSession
    x, dimension = entries(vectors, key, vector)
    n, sums = _exact_sums(x, dimension) if dimension else (0, [])
    if n == 0:
        return spark.createDataFrame([], SCHEMA)
    found = spectrum(x, dimension)
    centred = Centred(n, sums)
    # As many spare directions as wanted ones.
    start = found.vectors[:, ::-1][:, : min(dimension, 2 * components)]
    values, directions, trace = refine(x, dimension, centred, start, components)
    real = values > dimension * EPS * trace
    values, directions = values[real], directions[:, real]
    count = len(values)
    if count == 0:
        return spark.createDataFrame([], SCHEMA)
    scaled = directions / np.sqrt(values)

    def square(rows: np.ndarray) -> np.ndarray:
        white = centred(rows) @ scaled
        return white.T @ white

    identity = _summed(x, dimension, square, (count, count)) / n
    error = float(np.abs(identity - np.eye(count)).max())
    explained = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch, dimension)
            if not len(rows):
                continue
            white = centred(rows) @ scaled
            # In the order of rows, then components.
            each = pa.array(np.repeat(np.arange(len(rows)), count))
            deviation = pa.array(centred.deviations(rows), pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id").take(each),
                    "component": pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                    "n": pa.array(np.full(len(rows) * count, n, np.int64)),
                    "deviation": deviation.take(each),
                    "whitened": pa.array(white.ravel()),
                    "explained": pa.array(np.tile(explained, len(rows))),
                    "identity_error": pa.array(np.full(len(rows) * count, error)),
                }
            )

    return common.mapped(x, run, SCHEMA)
