"""Hard negatives by an inverted multi-index with certified stops.

Two codebooks, one for each half of the vectors, form the cells of the index. The score
(integer inner product) of an anchor with any vector of a cell is at most the sum of its
half-scores with the two codewords plus the lengths of its halves times the radii of the
codewords. A multi-sequence heap visits cells by falling bounds. First an anchor visits cells
until they hold a few thousand vectors, and takes the scores found there; then all further cells
whose bound reaches the worst score that still counts. What is left unvisited cannot change the
answer, so results are exact whatever the codebooks are worth.

That is done twice: for the positives, and for the windows of scores below each positive
in which the negatives lie. Vectors are dealt by the codeword of their first half and cut into
blocks of a fixed number; an anchor is sent to a block once, with the cells it visits there.

Equal vectors of a label form a class that is searched once and stands for its smallest
ids, as many as an answer can hold.

Rows: a null label, id or vector, null or non-finite components, components whose integer
does not fit 26 bits, or another length than the most frequent one (the longer of two): no part. A
repeated row counts once for each different vector and label of its id, as anchor, positive and
negative. An anchor without other rows of its label, and a positive without rows in its
window, has no rows in the result. An empty table gives an empty table. Only the id, the vector
and the label are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, multi_index
from tidemark.llm.multi_index import Grid, multi_sequence

FACTOR = 256
# Components are integers of so many bits; products of two thousand of them fit a long.
BITS = 26
POSITIVES = NEGATIVES = 5
# Negatives score at least this percentage of their positive, and at most as much.
LOW_PERCENT = 80
CODEWORDS = 16
# Vectors in the cells that an anchor visits first.
FIRST = 4096
# Vectors of a block, anchors of a task, anchors scored together.
BLOCK, ANCHORS, STEP = 16384, 1024, 128
SCHEMA = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def integer_rows(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``id``, ``label`` as text and integer components ``v`` of the rows that take part."""
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & multi_index.usable("v"))
    rows = rows.filter(~F.exists("v", lambda c: F.abs(c) >= float(1 << BITS) / FACTOR))
    return rows.withColumn("v", F.transform("v", lambda c: F.floor(c * FACTOR)))


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two float matrices that hold integers."""
    most = float(np.abs(a).max(initial=0.0)) * float(np.abs(b).max(initial=0.0)) * a.shape[1]
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    low = np.mod(b, 1 << 14)
    high = (b - low) / (1 << 14)
    halves = np.mod(a, 1 << 14)
    rest = (a - halves) / (1 << 14)

    def whole(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x @ y.T).astype(np.int64)

    return whole(halves, low) + ((whole(halves, high) + whole(rest, low)) << 14) + (whole(rest, high) << 28)


def _top(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` best allowed scores of each row; earlier columns first in ties."""
    columns = scores.shape[1]
    order = np.where(allowed, scores, np.iinfo(np.int64).min)
    if columns > k:
        # The k-th best score; of its ties the first columns fill the places that are left.
        least = np.partition(order, columns - k, axis=1)[:, columns - k][:, None]
        above = order > least
        tied = (order == least) & allowed
        room = k - above.sum(1)[:, None]
        chosen = (above & allowed) | (tied & (np.cumsum(tied, axis=1) <= room))
    else:
        chosen = allowed
    return np.nonzero(chosen)


class Index:
    """The grid, radii of its codewords and the number of vectors in its cells."""

    def __init__(self, grid: Grid, held: dict[tuple[int, int], tuple[int, float, float]]):
        self.grid = grid
        self.held = {cell: n for cell, (n, _, _) in held.items()}
        rows, columns = grid.shape
        self.radii = np.zeros(rows), np.zeros(columns)
        for (i, j), (_, left, right) in held.items():
            self.radii[0][i] = max(self.radii[0][i], left)
            self.radii[1][j] = max(self.radii[1][j], right)

    def bounds(self, anchors: np.ndarray) -> list[np.ndarray]:
        """Largest possible half-scores with the vectors of each codeword."""
        out = []
        for half, centres, radius in zip(
            self.grid.halves(anchors), (self.grid.left, self.grid.right), self.radii, strict=True
        ):
            size = np.sqrt((half * half).sum(1))[:, None]
            bound = half @ centres.T + size * radius[None, :]
            # More than rounding can take away.
            out.append(bound + 1e-9 * (np.abs(half) @ np.abs(centres.T) + size * radius[None, :]) + 1e-3)
        return out

    def visits(self, left: np.ndarray, right: np.ndarray, first: int, least: float | None) -> list[tuple[int, int]]:
        """Cells to visit: without ``least`` those that come first, otherwise the rest with bounds that reach it."""
        seen, out = 0, []
        for i, j, cost in multi_sequence(-left, -right):
            fresh = seen >= first
            if (least is None and fresh) or (least is not None and fresh and -cost < least):
                break
            held = self.held.get((i, j), 0)
            if held and fresh == (least is not None):
                out.append((i, j))
            seen += held
        return out


def _sent(asked: DataFrame, index: Index, dimension: int, first: int, kept: str) -> DataFrame:
    """A row per anchor and region with the cells to visit there, as second codewords.

    ``asked`` has ``cid``, ``v``, the columns ``kept`` names and, from the second round on, ``least``.
    """
    later = "least" in asked.columns
    fields = [asked.schema[name] for name in ["cid", "v", *kept.split()]]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.array(batch.column("v").flatten(), np.float64).reshape(-1, dimension)
            left, right = index.bounds(v) if len(v) else ([], [])
            least = batch.column("least").to_pylist() if later else [None] * len(v)
            rows, regions, cells = [], [], []
            for at in range(len(v)):
                here: dict[int, list[int]] = {}
                for i, j in index.visits(left[at], right[at], first, least[at]):
                    here.setdefault(i, []).append(j)
                for i, js in here.items():
                    rows.append(at)
                    regions.append(i)
                    cells.append(js)
            take = pa.array(rows, pa.int64())
            columns = {f.name: batch.column(f.name).take(take) for f in fields}
            columns["i"] = pa.array(regions, pa.int32())
            columns["js"] = pa.array(cells, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return common.mapped(asked, run, f"{schema}, i int, js array<int>")


def _scored(
    sent: DataFrame, placed: DataFrame, pick: Callable, schema: str, dimension: int, block: int, anchors: int
) -> DataFrame:
    """``pick`` on the scores of the anchors that visit a cell with its vectors, block by block."""
    sent = common.written(sent, "negatives-sent")
    # One row per first codeword.
    sizes = placed.groupBy("i").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    crowds = sent.groupBy("i").agg(F.ceil(F.count("*") / anchors).cast("int").alias("tasks"))
    regions = F.broadcast(common.written(sizes.join(crowds, "i"), "negatives-regions"))
    held = placed.join(regions, "i").select(
        "cid", "label", "least_id", "v", "i", "j",
        F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"),
    )
    asked = sent.join(regions, "i").select(
        *sent.columns,
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("cid", F.lit(1)), F.col("tasks")).cast("int").alias("task"),
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(vectors):
            # Ties go to the smaller id.
            vectors = vectors.sort_values(["least_id", "label"], kind="stable")
            held = np.stack(vectors["v"].to_list()).astype(np.float64)
            asking = np.stack(queries["v"].to_list()).astype(np.float64)
            seconds = vectors["j"].to_numpy()
            for j in np.unique(seconds):
                own = np.flatnonzero(seconds == j)
                visiting = np.array([at for at, js in enumerate(queries["js"]) if j in js], np.int64)
                cell = vectors.iloc[own]
                for at in range(0, len(visiting), STEP):
                    some = visiting[at : at + STEP]
                    out.append(pick(queries.iloc[some], cell, _dot(asking[some], held[own])))
        if not out:
            return pd.DataFrame({name: pd.Series(dtype=object) for name in names})
        return pd.concat(out)[names]

    keys = ["i", "block", "task"]
    return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(run, schema)


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` classes for each key: higher scores first, then the smaller id and label."""
    order = f"row_number() over (partition by {', '.join(keys)} order by score desc, least_id, other)"
    return found.withColumn("place", F.expr(order)).filter(F.col("place") <= k).drop("place")


def _positives(
    asked: DataFrame, placed: DataFrame, index: Index, dimension: int, first: int, block: int, anchors: int
) -> DataFrame:
    """The best classes of the anchor's label, its own too, for each anchor class: ``cid, other, score, ids``."""
    k = POSITIVES + 1
    schema = "cid binary, other binary, least_id long, score long"

    def pick(queries: pd.DataFrame, cell: pd.DataFrame, scores: np.ndarray) -> pd.DataFrame:
        allowed = queries["label"].to_numpy()[:, None] == cell["label"].to_numpy()[None, :]
        row, column = _top(scores, allowed, k)
        return pd.DataFrame(
            {
                "cid": queries["cid"].to_numpy()[row],
                "other": cell["cid"].to_numpy()[column],
                "least_id": cell["least_id"].to_numpy()[column],
                "score": scores[row, column],
            }
        )

    def round_of(frame: DataFrame) -> DataFrame:
        sent = _sent(frame, index, dimension, first, "label")
        found = _scored(sent, placed, pick, schema, dimension, block, anchors)
        return common.written(_best(found, ["cid"], k), "negatives-positives")

    near = round_of(asked)
    worst = near.groupBy("cid").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    # Fewer than wanted: every cell has to be seen.
    least = F.when(F.col("n") >= k, F.col("score").cast("double")).otherwise(float("-inf"))
    further = asked.join(worst, "cid", "left").select("cid", "label", "v", F.coalesce(least, F.lit(float("-inf"))).alias("least"))
    return _best(near.unionByName(round_of(further)), ["cid"], k)


def _negatives(
    asked: DataFrame, placed: DataFrame, index: Index, dimension: int, first: int, block: int, anchors: int
) -> DataFrame:
    """The best classes of other labels in the window of each positive score: ``cid, top, other, score``.

    ``asked`` has the scores of the anchor's positives as ``tops``, in falling order.
    """
    schema = "cid binary, top long, other binary, least_id long, score long"

    def pick(queries: pd.DataFrame, cell: pd.DataFrame, scores: np.ndarray) -> pd.DataFrame:
        others = queries["label"].to_numpy()[:, None] != cell["label"].to_numpy()[None, :]
        tops = queries["tops"].to_list()
        out = []
        for at in range(max(map(len, tops))):
            live = np.array([len(t) > at for t in tops])
            top = np.array([t[at] if len(t) > at else 0 for t in tops], np.int64)
            window = (100 * scores >= LOW_PERCENT * top[:, None]) & (scores <= top[:, None])
            row, column = _top(scores, window & others & live[:, None], NEGATIVES)
            out.append(
                pd.DataFrame(
                    {
                        "cid": queries["cid"].to_numpy()[row],
                        "top": top[row],
                        "other": cell["cid"].to_numpy()[column],
                        "least_id": cell["least_id"].to_numpy()[column],
                        "score": scores[row, column],
                    }
                )
            )
        return pd.concat(out)

    def round_of(frame: DataFrame) -> DataFrame:
        sent = _sent(frame, index, dimension, first, "label tops")
        found = _scored(sent, placed, pick, schema, dimension, block, anchors)
        return common.written(_best(found, ["cid", "top"], NEGATIVES), "negatives-windows")

    near = round_of(asked)
    worst = near.groupBy("cid", "top").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    floor = F.col("top") * LOW_PERCENT / 100.0
    windows = asked.select("cid", F.explode("tops").alias("top")).join(worst, ["cid", "top"], "left")
    # A full window needs nothing below its worst score, any other nothing below its end.
    full = F.coalesce(F.col("n") >= NEGATIVES, F.lit(False))
    least = F.when(full, F.col("score").cast("double")).otherwise(floor)
    # Above a negative score there is no window.
    least = windows.filter("top >= 0").groupBy("cid").agg(F.min(least).alias("least"))
    further = asked.join(least, "cid").select("cid", "label", "tops", "v", "least")
    return _best(near.unionByName(round_of(further)), ["cid", "top"], NEGATIVES)


def mine(
    vectors: DataFrame,
    asked: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    codewords: int = CODEWORDS,
    first: int = FIRST,
    block: int = BLOCK,
    anchors: int = ANCHORS,
) -> DataFrame:
    """The hard negatives of each anchor and positive; ``asked`` tells anchors by the column ``id``."""
    spark = vectors.sparkSession
    rows = integer_rows(vectors, key, vector, label)
    dimension, _ = multi_index.usual_length(rows, "v")
    if dimension == 0:
        return spark.createDataFrame([], SCHEMA)
    rows = rows.filter(F.size("v") == dimension)
    text = F.concat_ws("|", F.col("label").cast("string"), F.col("v").cast("string"))
    rows = rows.withColumn("cid", F.unhex(F.sha2(text, 256)))
    # A class keeps as many of its smallest ids as an answer can hold, and one for the anchor itself.
    keep = max(POSITIVES, NEGATIVES) + 1
    few = rows.select("cid", "label", "id").distinct()
    few = few.withColumn("place", F.expr("row_number() over (partition by cid order by id)"))
    ids = few.filter(F.col("place") <= keep).groupBy("cid").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    whole = rows.groupBy("cid").agg(F.first("label").alias("label"), F.first("v").alias("v"))
    classes = common.written(whole.join(ids, "cid"), "negatives-classes")
    size = classes.count()
    if size == 0:
        return spark.createDataFrame([], SCHEMA)
    sample = multi_index.sample_of(classes, size, F.col("cid"), "v")
    grid = multi_index.fit(sample, codewords)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.array(batch.column("v").flatten(), np.float64).reshape(-1, dimension)
            left, right = grid.distances(v)
            i, j = left.argmin(1) if len(v) else [], right.argmin(1) if len(v) else []
            at = np.arange(len(v))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(i, pa.int32()),
                    pa.array(j, pa.int32()),
                    pa.array(np.sqrt(left[at, i]) if len(v) else [], pa.float64()),
                    pa.array(np.sqrt(right[at, j]) if len(v) else [], pa.float64()),
                ],
                [*batch.schema.names, "i", "j", "ri", "rj"],
            )

    base = classes.select("cid", "label", "v", F.element_at("ids", 1).alias("least_id"))
    placed = common.mapped(
        base, cells, "cid binary, label string, v array<long>, least_id long, i int, j int, ri double, rj double"
    )
    placed = common.written(placed, "negatives-cells")
    # At most one row for each pair of codewords.
    held = placed.groupBy("i", "j").agg(F.count("*"), F.max("ri"), F.max("rj")).collect()
    # Distances lose some digits where they are small.
    slack = 1e-6 * (1.0 + max(float(np.abs(grid.left).max(initial=0)), float(np.abs(grid.right).max(initial=0))))
    index = Index(grid, {(r[0], r[1]): (r[2], r[3] + slack, r[4] + slack) for r in held})
    queries = common.written(rows.filter(asked).select(F.col("id").alias("anchor_id"), "cid").distinct(), "negatives-anchors")
    sought = queries.select("cid").distinct().join(classes.select("cid", "label", "v"), "cid")
    sizes = dimension, first, block, anchors
    near = _positives(sought, placed, index, *sizes)
    near = common.written(near.join(classes.select(F.col("cid").alias("other"), "ids"), "other"), "negatives-near")
    # The best rows behind the best classes: ties between classes go by id.
    listed = near.select("cid", "score", F.explode("ids").alias("positive_id"), (F.col("cid") == F.col("other")).alias("own"))
    order = "row_number() over (partition by cid order by score desc, positive_id, own)"
    listed = listed.withColumn("place", F.expr(order)).filter(F.col("place") <= POSITIVES + 1)
    listed = common.written(listed, "negatives-listed")
    tops = listed.groupBy("cid").agg(F.sort_array(F.collect_set("score"), asc=False).alias("tops"))
    windows = _negatives(sought.join(tops, "cid").select("cid", "label", "tops", "v"), placed, index, *sizes)
    negatives = windows.join(classes.select(F.col("cid").alias("other"), "ids"), "other")
    negatives = negatives.select("cid", "top", F.col("score").alias("negative_score"), F.explode("ids").alias("negative_id"))
    rank = "row_number() over (partition by cid, top order by negative_score desc, negative_id)"
    negatives = negatives.withColumn("rank", F.expr(rank)).filter(F.col("rank") <= NEGATIVES)
    # An anchor is no positive of its own; another vector of the same id is.
    pairs = queries.join(listed, "cid").filter(~(F.col("own") & (F.col("positive_id") == F.col("anchor_id"))))
    first_ones = "row_number() over (partition by anchor_id, cid order by score desc, positive_id, place)"
    pairs = pairs.withColumn("nth", F.expr(first_ones)).filter(F.col("nth") <= POSITIVES)
    pairs = pairs.withColumn("top", F.col("score"))
    return pairs.join(negatives, ["cid", "top"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )
