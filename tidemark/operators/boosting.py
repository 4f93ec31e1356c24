"""Boosted trees on log loss from histograms: the trees of Spark ML's classifier, with less work a row.

One stage fits all trees. Each task holds its share of the rows as bins, labels and margins, 27 bytes a row for
seventeen features, so nothing is moved or read again between hundreds of passes. Every level of every tree is a
pass over all rows; then the tasks, which run at once, add up their sums per node, feature and bin, whose number
does not grow with the rows, and all find the same splits. Two features share one number, so a pass counts nine pairs
of bins a row. Bins, gains, leaves and weights follow Spark ML's rules, and the result is its model.
"""

from __future__ import annotations

import os
import pickle
import sys
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import store

# Rows from which the borders of bins are taken, as in Spark ML.
BORDER_ROWS = 10_000
# Rows that one step works on, and least rows of a task.
BLOCK_ROWS = PART_ROWS = 1 << 16
# Most such shares that one task takes where tasks cannot run at once.
ALONE_PARTS = 16
# Seconds between looks for the sums of the others, and after which they are given up.
LOOK, PATIENCE = 0.002, 3600
_BITS = 5
_BINS = 1 << _BITS
_ROWS = "bins binary, label binary"
_EPSILON = 2.0**-52

# Tasks get the functions themselves: their Python need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def borders(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between bins of about equally many values, as Spark ML takes them."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= bins - 1:
        return middles
    stride = len(values) / bins
    found, seen, target = [], float(counts[0]), stride
    for middle, count in zip(middles, counts[1:], strict=True):
        before, seen = seen, seen + float(count)
        if abs(before - target) < abs(seen - target):
            found.append(middle)
            target += stride
    return np.array(found)


@dataclass
class _Block:
    """Some rows: pairs of bins, labels of -1 and 1, and the margins that the trees so far give."""

    bins: np.ndarray
    label: np.ndarray
    margin: np.ndarray

    def rest(self, first: bool) -> np.ndarray:
        """What the next tree explains: the first one the labels, each other one the slope of the loss."""
        label = self.label.astype(np.float64)
        return label if first else 4.0 * label / (1.0 + np.exp(2.0 * label * self.margin))

    def places(self, splits: dict[int, tuple[float, int, int]], size: int, levels: int) -> np.ndarray:
        """The node of each row after so many levels; rows in leaves stay there."""
        feature, at = np.full(size, -1), np.zeros(size, np.int64)
        for node, (_, of, bin_) in splits.items():
            feature[node], at[node] = of, bin_
        rows = len(self.label)
        pair, shift = np.maximum(feature, 0) // 2 * rows, np.where(feature % 2 == 0, _BITS, 0)
        place, own, flat = np.ones(rows, np.int64), np.arange(rows), self.bins.ravel()
        for _ in range(levels):
            bins = (flat[pair[place] + own] >> shift[place]) & (_BINS - 1)
            place = np.where(feature[place] < 0, place, 2 * place + (bins > at[place]))
        return place

    def move(self, splits: dict, value: np.ndarray, weight: float, depth: int) -> None:
        self.margin += weight * value[self.places(splits, len(value), depth)]


def _binned(thresholds: Sequence[np.ndarray], size: int) -> Callable:
    """Rows of a label and features as blocks of bins and labels."""

    def block(values: np.ndarray) -> pa.RecordBatch:
        label, features = values[0], values[1:]
        if np.isnan(values).any():
            raise ValueError("training rows hold NULL or NaN")
        if not np.isin(label, (0.0, 1.0)).all():
            raise ValueError("labels are 0 and 1")
        bins = np.zeros((len(features) + len(features) % 2, len(label)), np.uint16)
        for place, (borders_, column) in enumerate(zip(thresholds, features, strict=True)):
            bins[place] = np.searchsorted(borders_, column, side="left")
        pairs = (bins[::2] << _BITS) | bins[1::2]
        columns = (pairs, (2 * label - 1).astype(np.int8))
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["bins", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], np.float64))
            rows += batch.num_rows
            if rows >= size:
                whole = np.concatenate(held, axis=1)
                full = rows - rows % size
                for start in range(0, full, size):
                    yield block(whole[:, start : start + size])
                held, rows = [whole[:, full:]], rows - full
        if rows:
            yield block(np.concatenate(held, axis=1))

    return run


def _summed(
    blocks: Sequence[_Block], pairs: int, first: bool, splits: dict, nodes: Sequence[int], size: int, level: int
) -> np.ndarray:
    """Rows, sums and sums of squares of what is to be explained, per pair, feature of it, open node and bin."""
    slots = np.full(size, len(nodes))
    slots[list(nodes)] = range(len(nodes))
    sums = np.zeros((3, pairs, (len(nodes) + 1) << (2 * _BITS)))
    for block in blocks:
        rest = block.rest(first)
        squares = rest * rest
        # Rows whose node is closed share one more slot, which is left out below.
        node = slots[block.places(splits, size, level)] << (2 * _BITS)
        for pair, bins in enumerate(block.bins):
            key = node + bins
            sums[0, pair] += np.bincount(key, minlength=sums.shape[2])
            sums[1, pair] += np.bincount(key, rest, sums.shape[2])
            sums[2, pair] += np.bincount(key, squares, sums.shape[2])
    both = sums.reshape(3, pairs, len(nodes) + 1, _BINS, _BINS)[:, :, :-1]
    return np.stack([both.sum(axis=4), both.sum(axis=3)], axis=2)


def _impurity(stats: np.ndarray) -> np.ndarray:
    n, total, squares = stats
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, (squares - total * total / n) / n, 0.0)


def _best(sums: np.ndarray, bins: Sequence[int]) -> tuple[float, int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Gain, feature, bin, both sides' sums of the best split of a node, the first of equal ones, and its own sums.

    The feature is -1 if no split gains anything.
    """
    whole = sums[:, 0].sum(axis=1)
    best = (0.0, -1, 0, whole, whole, whole)
    impurity = _impurity(whole)
    for feature, count in enumerate(bins):
        if count < 2:
            continue
        sides = np.cumsum(sums[:, feature, :count], axis=1)
        left, right = sides[:, :-1], sides[:, -1:] - sides[:, :-1]
        share = left[0] / whole[0]
        gain = impurity - share * _impurity(left) - right[0] / whole[0] * _impurity(right)
        gain = np.where((left[0] > 0) & (right[0] > 0), gain, -np.inf)
        at = int(np.argmax(gain))
        if gain[at] > best[0]:
            best = float(gain[at]), feature, at, left[:, at], right[:, at], whole
    return best


def _grown(summed: Callable, bins: Sequence[int], depth: int) -> tuple[dict, dict, np.ndarray]:
    """A tree, a pass for each level: sums of the nodes, splits (gain, feature and last bin on the left), means.

    Nodes are numbered by place: the children of ``i`` are ``2 * i`` and ``2 * i + 1``, the root is 1.
    """
    size = 2 << depth
    stats: dict[int, np.ndarray] = {}
    splits: dict[int, tuple[float, int, int]] = {}
    nodes = [1]
    for level in range(depth):
        if not nodes:
            break
        single = summed(splits, nodes, size, level)
        single = single.transpose(3, 0, 1, 2, 4).reshape(len(nodes), 3, -1, _BINS)
        following = []
        for node, own in zip(nodes, single, strict=True):
            gain, feature, at, *sides, whole = _best(own, bins)
            stats.setdefault(node, whole)
            if feature < 0:
                continue
            splits[node] = gain, feature, at
            for child, side in zip((2 * node, 2 * node + 1), sides, strict=True):
                stats[child] = side
                if abs(_impurity(side)) >= _EPSILON:
                    following.append(child)
        nodes = following
    value = np.zeros(size)
    for node, (n, total, _) in stats.items():
        value[node] = total / n
    return stats, splits, value


def _added(folder: str, part: int, parts: int) -> Callable[[np.ndarray], np.ndarray]:
    """Adds up the sums of all tasks, in one order in each of them, through files that all tasks see."""
    os.makedirs(folder, exist_ok=True)
    done = 0

    def path(step: int, of: int) -> str:
        return f"{folder}/{step}-{of}"

    def add(own: np.ndarray) -> np.ndarray:
        nonlocal done
        own.tofile(path(done, part) + ".part")
        os.replace(path(done, part) + ".part", path(done, part))
        total, until = np.zeros(own.shape), time.monotonic() + PATIENCE
        for of in range(parts):
            while not os.path.exists(path(done, of)):
                if time.monotonic() > until:
                    raise TimeoutError(f"no sums of task {of} in step {done}")
                time.sleep(LOOK)
            total += np.fromfile(path(done, of)).reshape(own.shape)
        # Whoever wrote this step has read the one before.
        if done:
            os.remove(path(done - 1, part))
        done += 1
        return total

    return add


def _boosted(bins: Sequence[int], depth: int, trees: int, rate: float, parts: int, folder: str) -> Callable:
    """All trees, from one task; the others work along and return nothing."""
    pairs = (len(bins) + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in batches:
            for found, label in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                found = np.frombuffer(found, np.uint16).reshape(pairs, -1)
                blocks.append(_Block(found, np.frombuffer(label, np.int8), np.zeros(len(label))))
        part, add = TaskContext.get().partitionId(), np.asarray
        if parts > 1:
            # A name that the tasks of this attempt share, and no other attempt has.
            names = BarrierTaskContext.get().allGather(uuid.uuid4().hex)
            add = _added(f"{folder}/{names[0]}", part, parts)
        grown = []
        for i in range(trees):

            def summed(*tree, first: bool = not i) -> np.ndarray:
                return add(_summed(blocks, pairs, first, *tree))

            stats, splits, value = _grown(summed, bins, depth)
            for block in blocks:
                block.move(splits, value, rate if i else 1.0, depth)
            grown.append((stats, splits, value))
        if part == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(grown)], pa.binary())], ["trees"])

    return run


def _model(
    gbt: GBTClassifier, grown: list, thresholds: Sequence[np.ndarray], rows: DataFrame
) -> GBTClassificationModel:
    """The trees as Spark ML's model; two leaves of one mean are one leaf."""
    sc = rows.sparkSession.sparkContext
    jvm, ml = sc._jvm, sc._jvm.org.apache.spark.ml
    # Each dot of a class name asks the JVM again.
    cut, calculator = jvm.java.util.Arrays.copyOfRange, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    leaf, inner, border = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    single = ml.regression.DecisionTreeRegressionModel

    def node(place: int, stats: dict, splits: dict, means: np.ndarray, sums, starts: dict):
        def own():
            start = 3 * starts[place]
            return calculator(cut(sums, start, start + 3), int(stats[place][0]))

        value, impurity = float(means[place]), float(_impurity(stats[place]))
        if place not in splits:
            return leaf(value, impurity, own()), value
        (left, a), (right, b) = (
            node(2 * place + side, stats, splits, means, sums, starts) for side in (0, 1)
        )
        if a is not None and a == b:
            return leaf(value, impurity, own()), value
        gain, feature, at = splits[place]
        split = border(feature, float(thresholds[feature][at]))
        return inner(value, impurity, gain, left, right, split, own()), None

    trees = sc._gateway.new_array(single, len(grown))
    shares = sc._gateway.new_array(jvm.double, len(grown))
    for i, (stats, splits, means) in enumerate(grown):
        sums = _py2java(sc, DenseVector(np.concatenate(list(stats.values())))).toArray()
        root, _ = node(1, stats, splits, means, sums, {place: at for at, place in enumerate(stats)})
        trees[i] = single(f"{gbt.uid}_tree_{i}", root, len(thresholds))
        shares[i] = gbt.getStepSize() if i else 1.0
    gbt._transfer_params_to_java()
    fitted = ml.classification.GBTClassificationModel(gbt.uid, trees, shares, len(thresholds), 2)
    model = GBTClassificationModel(gbt._java_obj.copyValues(fitted, ml.param.ParamMap()))
    return gbt._copyValues(model)


def _tasks(spark: SparkSession, folder: str) -> int:
    """Tasks that run at once and see the folder as files; one where Spark cannot promise that."""
    sc = spark.sparkContext._jsc.sc()
    if ":" in folder or sc.getConf().getBoolean("spark.dynamicAllocation.enabled", False):
        return 1
    slots = sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile())
    return max(1, min(slots, sc.defaultParallelism()))


def fit(
    gbt: GBTClassifier, train: DataFrame, label: str, features: Sequence[str]
) -> GBTClassificationModel | None:
    """Fit the classifier's trees on all rows; the label is 0 or 1.

    Borders of bins come from ``BORDER_ROWS`` rows, or all if there are no more. None if there are more rows than
    one task should hold, and no tasks that run at once.
    """
    spark = train.sparkSession
    rows = train.select(F.col(label).cast("double"), *(F.col(name).cast("double") for name in features))
    count = rows.count()
    if not count:
        raise ValueError("no training rows")
    folder = store.new_path(spark, "boosting")
    local = folder.removeprefix("file://") if folder.startswith("file:///") else folder.removeprefix("file:")
    tasks, wanted = _tasks(spark, local), max(1, count // PART_ROWS)
    if tasks == 1 and wanted > ALONE_PARTS:
        return None
    parts = min(tasks, wanted)
    some = rows if count <= BORDER_ROWS else rows.sample(BORDER_ROWS / count, gbt.getSeed())
    most = min(gbt.getMaxBins(), _BINS, count)
    seen = (column.to_numpy() for column in some.select(*features).toArrow().columns)
    thresholds = [borders(values[~np.isnan(values)], most) for values in seen]
    bins = [len(found) + 1 for found in thresholds]
    # As many blocks as spread evenly over the parts.
    size = min(BLOCK_ROWS, -(-count // (4 * parts)))
    blocks = rows.mapInArrow(_binned(thresholds, size), _ROWS).repartition(parts)
    work = _boosted(bins, gbt.getMaxDepth(), gbt.getMaxIter(), gbt.getStepSize(), parts, local)
    try:
        found = blocks.mapInArrow(work, "trees binary", barrier=parts > 1).toArrow()
    finally:
        store.removed(spark, folder)
    return _model(gbt, pickle.loads(found.column(0)[0].as_py()), thresholds, rows)
