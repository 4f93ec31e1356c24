"""Nearest neighbours by inner product along shifted space-filling curves.

Vectors are cut into bands of about equal norms, and each band has curves of its own. Its
vectors get one more component that makes all of them equally long, so that the
largest inner product is the smallest distance; queries are looked up in every band. Random rotations, cut into groups of a
few directions, project the vectors; each group gives one Hilbert curve with its own
random shift, and its keys order all vectors by range partitioning. Keys are fine enough
to tell apart the vectors of groups far smaller than the table; where they still tie,
each curve has an order of its own. Positions along a curve are cut into blocks; every query goes to the blocks that its window touches, is
scored there against all vectors of the block in double precision, and the best of
all curves are merged.

Equal vectors form a class that is searched once and stands for its smallest ids, as
many as an answer can hold. The window is a share of all classes of a band: in data without any
structure the share of the true neighbours that the curves find depends on the share
of the vectors that they look at. Blocks hold a fixed number of vectors at any size.

Rows: null and zero vectors and those with null or non-finite components or another
length than ``dimension`` (by default that of most different vectors) take no part; a repeated id counts once for each different
vector; fewer candidates than asked for give fewer rows; an empty table gives an empty
table; only the id and the vector are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

CURVES = 16
DIRECTIONS = 8
# Bits of a coordinate in a key: vectors that differ in single precision have different keys.
BITS = 40
# Vectors that a query is scored against on one curve, as a share of all.
WINDOW_SHARE = 1 / 15
# Vectors on each side of a query that it is scored against at least.
LEAST_WINDOW = 512
BLOCK = 1024
# Coordinates are cut off beyond this many standard deviations.
REACH = 4.0
SHIFT = 0.5
# Norms are counted in steps, so many to each factor of two; a band spans BAND_STEPS.
NORM_STEPS = 32
BAND_STEPS = 4
# Queries that one task scores against a block.
TASK_QUERIES = 4096
SEED = 20260101


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of cell numbers below ``2 ** bits``.

    Works on all rows at a time: undoes the rotations of the curve from the coarsest
    level on, takes the Gray code and interleaves the bits.
    """
    x = _transposed(cells, bits)
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(x.shape[1]):
            key = (key << 1) | ((x[:, i] >> level) & 1)
    return key


def key_bytes(cells: np.ndarray, bits: int) -> np.ndarray:
    """The same positions with any number of bits, as rows of bytes in the order of the curve."""
    x = _transposed(cells, bits)
    levels = np.arange(bits - 1, -1, -1)
    held = (x[:, None, :] >> levels[None, :, None]) & 1
    return np.packbits(held.astype(np.uint8).reshape(len(x), -1), axis=1)


def _transposed(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the curve with their bits dealt in turn over the columns."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            high = (x[:, i] & bit) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, n - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= flip[:, None]
    return x


class Curves:
    """The projections and shifts of all curves, the same in every task."""

    def __init__(self, dimension: int, count: int, directions: int, bits: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.bits = bits
        width = min(directions, dimension)
        per_rotation = dimension // width
        self.maps, self.shifts = [], []
        for i in range(count):
            if i % per_rotation == 0:
                rotation = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0]
            at = i % per_rotation * width
            self.maps.append(rotation[:, at : at + width])
            self.shifts.append(rng.uniform(-SHIFT, SHIFT, width))

    def keys(self, vectors: np.ndarray, scale: float) -> np.ndarray:
        """Keys of the vectors on each curve, one curve after the other; ``scale`` is the usual size of a component."""
        cells = 1 << self.bits
        place = np.stack([vectors @ d / scale + s for d, s in zip(self.maps, self.shifts, strict=True)])
        cell = (place + REACH + SHIFT) / (2 * (REACH + SHIFT)) * cells
        cell = np.clip(cell, 0, cells - 1).reshape(-1, place.shape[2])
        return key_bytes(cell, self.bits).reshape(len(self.maps), len(vectors), -1)


def classes(vectors: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """One row per different usable vector: ``cid``, ``v``, its ``keep`` smallest ids, its squared length."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter("id is not null and v is not null").filter(~bad)
    # Adding zero makes the two zeros one.
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    rows = rows.filter(F.exists("v", lambda x: x != 0)).distinct()
    rank = F.expr("row_number() over (partition by v order by id)")
    few = rows.withColumn("rank", rank).filter(F.col("rank") <= keep)
    few = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return few.select(
        F.element_at("ids", 1).alias("cid"),
        F.expr("row_number() over (partition by element_at(ids, 1) order by v)").alias("nth"),
        "v",
        "ids",
        _norm("v").alias("norm"),
    )


def _norm(vector: str) -> Column:
    """The Euclidean norm; components are divided by the largest, so no square overflows or vanishes."""
    peak = F.array_max(F.transform(vector, F.abs))
    return peak * F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x / peak) * (x / peak)))


def _step() -> Column:
    return F.floor(F.log2("norm") * NORM_STEPS).cast("int")


def norm_bands(found: DataFrame) -> list[tuple[int, int, float, int]]:
    """Lowest and highest norm step, largest norm and number of classes of each band.

    Longest vectors first. There are at most as many steps as doubles have powers of two,
    times ``NORM_STEPS``, whatever the size of the table.
    """
    held = found.groupBy(_step().alias("step")).agg(F.max("norm").alias("most"), F.count("*").alias("n"))
    bands: list[tuple[int, int, float, int]] = []
    for step, most, n in sorted(map(tuple, held.collect()), reverse=True):
        if bands and bands[-1][1] - step < BAND_STEPS:
            _, high, longest, before = bands[-1]
            bands[-1] = (step, high, longest, before + n)
        else:
            bands.append((step, step, most, n))
    return bands


def _placed(
    found: DataFrame, bands: list[tuple[int, int, float, int]], dimension: int, asked: Column, whole: int
) -> DataFrame:
    """A row per class, curve and role (0 vector, 1 query) with its key.

    Curves are numbered through all bands. A vector lies on the curves of its band, a
    query on all; bands of up to ``whole`` vectors, which any window covers, have one curve.
    """
    source = found.select("cid", "nth", "v", "norm", _step().alias("step"), asked.alias("asked"))
    highest = np.array([-high for _, high, _, _ in bands])
    longest = np.array([most for _, _, most, _ in bands])
    counts = [1 if n <= whole else CURVES for *_, n in bands]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        curves = Curves(dimension + 1, CURVES, DIRECTIONS, BITS)
        scale = 1 / math.sqrt(dimension + 1)
        for batch in batches:
            cid, nth = batch.column("cid"), batch.column("nth")
            v = np.array(batch.column("v").flatten(), np.float64).reshape(-1, dimension)
            if not len(v):
                continue
            norm = np.array(batch.column("norm"))
            # Bands go from the highest step down; a vector is in the last that starts at or above its step.
            band = np.searchsorted(highest, -np.array(batch.column("step")), "right") - 1
            most = longest[band]
            share = np.minimum(1, norm / most)
            rest = np.sqrt((1 - share) * (1 + share))[:, None]
            points = np.hstack([v / most[:, None], rest])
            chosen = np.flatnonzero(batch.column("asked").to_numpy(False))
            queries = np.hstack([v[chosen] / norm[chosen, None], np.zeros((len(chosen), 1))])
            keys = curves.keys(np.vstack([points, queries]), scale)
            for at, count in enumerate(counts):
                own = np.flatnonzero(band == at)
                for role, rows, first in ((0, own, own), (1, chosen, len(v) + np.arange(len(chosen)))):
                    for number in range(count if len(rows) else 0):
                        take = pa.array(rows, pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(rows), at * CURVES + number, np.int32)),
                                _binary(keys[number][first]),
                                pa.array(np.full(len(rows), role, np.int32)),
                                cid.take(take),
                                nth.take(take),
                            ],
                            ["curve", "at", "role", "cid", "nth"],
                        )

    placed = common.mapped(source, run, "curve int, at binary, role int, cid long, nth int")
    # Equal keys: on each curve in another order, with queries among the vectors.
    return placed.withColumn("tie", F.xxhash64("curve", "cid", "nth", "role"))


def _binary(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows).tobytes())]
    )


def _positions(placed: DataFrame) -> DataFrame:
    """Adds ``position``: the vectors before a row on its curve.

    Rows are range-partitioned and sorted; a partition counts its own vectors, and the
    counts of all partitions, one row for each curve in it, are summed up.
    """
    parts = max(1, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["curve", "at", "tie", "role", "cid", "nth"]
    lined = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    lined = lined.select("curve", "role", "cid", "nth")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        curve, n = -1, 0
        for batch in batches:
            curves, roles = (batch.column(c).to_numpy(False) for c in ("curve", "role"))
            before = np.zeros(len(roles), np.int64)
            for number in np.unique(curves).tolist():
                if number != curve:
                    curve, n = number, 0
                own = np.flatnonzero(curves == number)
                seen = np.cumsum(roles[own] == 0)
                before[own] = n + seen - (roles[own] == 0)
                n += int(seen[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], [*batch.schema.names, "before"])

    lined = common.mapped(lined, count, "curve int, role int, cid long, nth int, before long")
    lined = common.written(lined.withColumn("part", F.spark_partition_id()), "curve-order")
    held = lined.groupBy("curve", "part").agg(F.sum(1 - F.col("role")).alias("n"))
    base = held.select("curve", "part", F.expr("sum(n) over (partition by curve order by part) - n").alias("base"))
    return lined.join(base, ["curve", "part"]).withColumn("position", F.col("before") + F.col("base"))


def _best(frames: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best vectors of one block for each query that touches it."""
    is_query = frames["role"].to_numpy() == 1
    queries, held = frames[is_query], frames[~is_query]
    names = ["q", "qn", "c", "cn", "score"]
    if not len(queries) or not len(held):
        return pd.DataFrame({n: pd.Series(dtype=float if n == "score" else "int64") for n in names})
    left, right = np.stack(queries["v"].to_list()), np.stack(held["v"].to_list())
    cid, nth = held["cid"].to_numpy(), held["nth"].to_numpy()
    out = []
    for at in range(0, len(left), 256):
        scores = left[at : at + 256] @ right.T
        for row, one in enumerate(scores, at):
            # Everything that ties with the last place stays.
            least = np.partition(one, len(one) - k)[len(one) - k] if len(one) > k else -np.inf
            best = np.flatnonzero(one >= least)
            best = best[np.lexsort((cid[best], -one[best]))][:k]
            q = queries.iloc[row]
            out.append(pd.DataFrame({"q": q["cid"], "qn": q["nth"], "c": cid[best], "cn": nth[best], "score": one[best]}))
    return pd.concat(out)[names]


def search(
    vectors: DataFrame,
    asked: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    window_share: float = WINDOW_SHARE,
    least_window: int = LEAST_WINDOW,
    dimension: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best vectors of each query row.

    Only vectors of length ``dimension`` take part; None stands for the most frequent length
    among different vectors, the longer one if two are as frequent.

    ``asked`` tells query rows by the column ``id``; a query is no neighbour of its own.
    """
    spark = vectors.sparkSession
    found = common.written(classes(vectors, key, vector, k + 1), "classes")
    schema = "query_id long, rank int, vec_id long, score double"
    if dimension is None:
        lengths = found.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"))
        usual = lengths.orderBy(F.desc("n"), F.desc("length")).first()
        if usual is None:
            return spark.createDataFrame([], schema)
        dimension = usual["length"]
    found = found.filter(F.size("v") == dimension)
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(asked).distinct()
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    # Hot vectors have few different ids here at most as often as they are asked for.
    queries = rows.join(found.select("v", "cid", "nth"), "v").select(F.col("id").alias("query_id"), "cid", "nth")
    queries = common.written(queries, "queries")
    bands = norm_bands(found)
    if not bands:
        return spark.createDataFrame([], schema)
    sizes = [
        (at * CURVES + number, n, max(least_window, math.ceil(n * window_share / 2)))
        for at, (*_, n) in enumerate(bands)
        for number in range(CURVES)
    ]
    sizes = F.broadcast(spark.createDataFrame(sizes, "curve int, size long, half long"))
    chosen = queries.select("cid", "nth").distinct().withColumn("asked", F.lit(True))
    marked = found.join(chosen, ["cid", "nth"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    lined = _positions(_placed(marked, bands, dimension, F.col("asked"), least_window)).join(sizes, "curve")
    low, high = F.greatest(F.lit(0), F.col("position") - F.col("half")), F.col("position") + F.col("half")
    last = F.floor((F.col("size") - 1) / block)
    touched = F.when(
        F.col("role") == 1,
        F.sequence(F.least(last, F.floor(low / block)), F.least(last, F.floor(high / block))),
    ).otherwise(F.array(F.floor(F.col("position") / block)))
    spread = lined.select("curve", "role", "cid", "nth", F.explode(touched).alias("block"))
    # A block that very many queries touch is scored in several tasks, one that none touches in none.
    crowds = spread.filter("role = 1").groupBy("curve", "block").agg(F.count("*").alias("n"))
    crowds = crowds.select("curve", "block", F.floor(F.col("n") / TASK_QUERIES).alias("last"))
    crowds = common.bounded(common.written(crowds, "crowds"))
    tasks = F.when(F.col("role") == 0, F.sequence(F.lit(0).cast("long"), F.col("last"))).otherwise(
        F.array(F.pmod(F.xxhash64("cid", "nth"), F.col("last") + 1))
    )
    spread = spread.join(crowds, ["curve", "block"])
    spread = spread.select("curve", "role", "cid", "nth", "block", F.explode(tasks).alias("task"))
    spread = spread.join(found.select("cid", "nth", "v"), ["cid", "nth"])
    best = spread.groupBy("curve", "block", "task").applyInPandas(
        lambda pdf: _best(pdf, k + 1), "q long, qn int, c long, cn int, score double"
    )
    best = best.groupBy("q", "qn", "c", "cn").agg(F.max("score").alias("score"))
    rank = F.expr("row_number() over (partition by q, qn order by score desc, c, cn)")
    best = best.withColumn("place", rank).filter(F.col("place") <= k + 1)
    ids = found.select(F.col("cid").alias("c"), F.col("nth").alias("cn"), "ids")
    listed = best.join(ids, ["c", "cn"]).groupBy("q", "qn").agg(
        F.collect_list(F.struct((-F.col("score")).alias("away"), "ids")).alias("found")
    )
    # Ties between classes go by id, so ids are put in order after they are listed.
    pairs = F.flatten(
        F.transform("found", lambda c: F.transform(c["ids"], lambda i: F.struct(c["away"].alias("away"), i.alias("id"))))
    )
    listed = listed.select(F.col("q").alias("cid"), F.col("qn").alias("nth"), F.array_sort(pairs).alias("found"))
    answers = queries.join(listed, ["cid", "nth"]).select(
        "query_id", F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k).alias("found")
    )
    return answers.select("query_id", F.posexplode("found").alias("rank", "hit")).select(
        "query_id",
        (F.col("rank") + 1).cast("int").alias("rank"),
        F.col("hit.id").alias("vec_id"),
        (-F.col("hit.away")).alias("score"),
    )
