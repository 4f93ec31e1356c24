"""Near-copies among vectors of one label by an inverted multi-index.

Independent codebooks on the halves of the normalised vectors form a product grid, and
every different vector lies in one cell of its label. To find its near-copies it visits cells in
the order of a multi-sequence traversal: the cost of a codeword is the squared distance to
the plane that separates it from the own codeword, which a near-copy has to cross, and the
costs of both halves add up. The traversal stops at target recall: two vectors that are
``threshold`` alike lie at most ``sqrt(2 - 2 * threshold)`` apart, and cells that a displacement of
that size in any direction reaches with a probability below ``1 - recall`` stay unvisited. (In
few dimensions the stop is the distance itself, and nothing is missed at all.) Found pairs
are verified by their cosine in double precision.

Cells are cut into blocks of a fixed number of vectors, and visitors of a block into
tasks. A task returns sums and a forest, never pairs: for each vector the number of vectors
it links with, and edges that connect what it has found connected. A pair counts for both sides
if either visits the other.

Equal vectors of a label form a class that is compared once and counts with its size.

Rows: a null label, a vector that is null, zero, holds null or non-finite components or
has another length than the most frequent one (the longer of two) links with nothing and
forms a component of its own. Repeated rows and ids are vectors of their own. A
component's id is its smallest vec_id; null ids count only where there is no other, and a
row with a null id is kept if its component has no id. An empty table gives an empty
table. Only the id, the vector and the label are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, graph, multi_index
from tidemark.llm.multi_index import Grid, multi_sequence

THRESHOLD = 0.98
RECALL = 0.9999
# Codewords of a half: LEAST at least, MOST at most, in between by the fourth root of the rows.
LEAST, MOST, PER_ROOT = 8, 256, 2.0
# Vectors of a cell in one block, visitors of a block in one task, visitors scored together.
BLOCK, VISITORS, STEP = 8192, 8192, 512


def reach(dimension: int, threshold: float, recall: float) -> float:
    """Largest summed cost of a cell that is visited.

    A random displacement of length ``r`` crosses planes of the two halves by independent normal
    amounts of variance ``r * r / dimension``; their squared sum exceeds ``c`` with probability
    ``exp(-c * dimension / (2 * r * r))``, and never ``r * r``.
    """
    square = max(0.0, 2.0 - 2.0 * threshold) * (1 + 1e-9)
    return square * min(1.0, -2.0 * math.log(1.0 - recall) / dimension)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by powers of two first, so that no square overflows or vanishes."""
    scaled = level(vectors)
    return scaled / np.sqrt((scaled * scaled).sum(1))[:, None]


def level(vectors: np.ndarray) -> np.ndarray:
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None])


def crossing(grid: Grid, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Own codewords of both halves, and the squared distance to the plane before each other one."""
    out = []
    for square, centres in zip(grid.distances(units), (grid.left, grid.right), strict=True):
        own = square.argmin(1)
        apart = np.sqrt(multi_index._squares(centres, centres))[own]
        with np.errstate(divide="ignore", invalid="ignore"):
            away = (square - square[np.arange(len(own)), own][:, None]) / (2.0 * apart)
        away = np.where(apart > 0, away, 0.0)
        # Rounded, so that batches of any size agree.
        out += [own, np.round(away * away, 12)]
    return out[0], out[2], out[1], out[3]


def _packed(vectors: np.ndarray) -> list[bytes]:
    """Bytes of each row, in single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        single = vectors.astype("<f4")
    exact = (single.astype(np.float64) == vectors).all(1)
    return [
        (single[i] if exact[i] else vectors[i].astype("<f8")).tobytes() for i in range(len(vectors))
    ]


def _unpacked(rows, dimension: int) -> np.ndarray:
    out = np.empty((len(rows), dimension))
    for i, row in enumerate(rows):
        out[i] = np.frombuffer(row, "<f4" if len(row) == 4 * dimension else "<f8")
    return out


def _linked(homes: pd.DataFrame, guests: pd.DataFrame, grid: Grid, dimension: int, most: float, threshold: float):
    """Counts and a forest of the links between the vectors of a block and its visitors."""
    names = ["a", "b", "links"]
    if not len(homes) or not len(guests):
        return pd.DataFrame({n: pd.Series(dtype="int64" if n == "links" else object) for n in names})
    held, asked = (level(_unpacked(f["vec"].to_list(), dimension)) for f in (homes, guests))
    held_size, asked_size = (np.sqrt((v * v).sum(1)) for v in (held, asked))
    own_left, own_right = int(homes["i"].iloc[0]), int(homes["j"].iloc[0])
    _, _, left, right = crossing(grid, unit(held))
    guest_left, guest_right = guests["hi"].to_numpy(), guests["hj"].to_numpy()
    held_n, asked_n = homes["n"].to_numpy(), guests["n"].to_numpy()
    held_id, asked_id = homes["cid"].to_list(), guests["cid"].to_list()
    number = {cid: at for at, cid in enumerate(held_id)}
    same = np.array([number.get(cid, -1) for cid in asked_id])
    # Nodes: the block's vectors, then visitors from elsewhere.
    nodes = np.where(same >= 0, same, len(held) + np.arange(len(asked)))
    parent = np.arange(len(held) + len(asked))
    counts = np.zeros(len(held) + len(asked), np.int64)
    for at in range(0, len(asked), STEP):
        part = slice(at, at + STEP)
        cosine = (asked[part] @ held.T) / (asked_size[part, None] * held_size[None, :])
        q, x = np.nonzero(cosine >= threshold)
        q = q + at
        other = same[q] != x
        q, x = q[other], x[other]
        np.add.at(counts, nodes[q], held_n[x])
        # Vectors of the block that do not visit the visitor's cell would never count it.
        alone = left[x, guest_left[q]] + right[x, guest_right[q]] > most
        alone &= (guest_left[q] != own_left) | (guest_right[q] != own_right)
        np.add.at(counts, x[alone], asked_n[q[alone]])
        graph.join(parent, nodes[q], x)
    ids = held_id + asked_id
    child, some = np.flatnonzero(parent != np.arange(len(parent))), np.flatnonzero(counts)
    return pd.DataFrame(
        {
            "a": [ids[i] for i in child] + [ids[i] for i in some],
            "b": [ids[parent[i]] for i in child] + [None] * len(some),
            "links": np.concatenate([np.zeros(len(child), np.int64), counts[some]]),
        },
        columns=names,
    )


def _keyed(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``vec_id``, ``label``, ``v`` and the class ``cid``, null for rows that link with nothing."""
    rows = vectors.select(
        F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    # Adding zero makes the two zeros one.
    rows = rows.withColumn("v", F.transform("v", lambda c: c + F.lit(0.0)))
    live = F.col("label").isNotNull() & multi_index.usable("v")
    live &= F.coalesce(F.exists("v", lambda c: c != 0), F.lit(False))
    dimension, _ = multi_index.usual_length(rows.filter(live), "v")
    live &= F.size("v") == dimension
    text = F.concat_ws("|", F.col("label").cast("string"), F.col("v").cast("string"))
    return rows.withColumn("cid", F.when(live, F.unhex(F.sha2(text, 256))))


def near_copies(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block: int = BLOCK,
    visitors: int = VISITORS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    rows = _keyed(vectors, key, vector, label)
    grouped = rows.filter("cid is not null").groupBy("cid")
    classes = grouped.agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count("*").alias("n")
    )
    classes = common.written(classes, "near-classes")
    size = classes.count()
    if size == 0:
        links = classes.select("cid", F.lit(0).cast("long").alias("n_links"), F.col("least").alias("component_id"))
    else:
        links = _class_links(classes, size, threshold, recall, block, visitors)
    joined = rows.select("vec_id", "cid").join(links, "cid", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _class_links(
    classes: DataFrame, size: int, threshold: float, recall: float, block: int, visitors: int
) -> DataFrame:
    """``cid, n_links, component_id`` of classes that have a link or more than one row."""
    words = min(MOST, max(LEAST, round(PER_ROOT * size**0.25)))
    sample = multi_index.sample_of(classes, size, F.col("cid"), "v")
    grid = multi_index.fit(unit(sample), words)
    dimension = sample.shape[1]
    most = reach(dimension, threshold, recall)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.array(batch.column("v").flatten(), np.float64).reshape(-1, dimension)
            if not len(v):
                continue
            own_left, own_right, left, right = crossing(grid, unit(v))
            visited = []
            for at in range(len(v)):
                row = []
                for i, j, cost in multi_sequence(left[at], right[at]):
                    if cost > most:
                        break
                    if i != own_left[at] or j != own_right[at]:
                        row.append({"i": i, "j": j})
                visited.append(row)
            yield pa.RecordBatch.from_pydict(
                {
                    "cid": batch.column("cid"),
                    "label": batch.column("label"),
                    "n": batch.column("n"),
                    "vec": pa.array(_packed(v), pa.binary()),
                    "hi": pa.array(own_left.astype(np.int32)),
                    "hj": pa.array(own_right.astype(np.int32)),
                    "visited": pa.array(visited, pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32())]))),
                }
            )

    kind = classes.schema["label"].dataType.simpleString()
    placed = common.mapped(
        classes.select("cid", "label", "n", "v"),
        cells,
        f"cid binary, label {kind}, n long, vec binary, hi int, hj int, visited array<struct<i:int,j:int>>",
    )
    placed = common.written(placed, "near-cells")
    home = F.col("hi").alias("i"), F.col("hj").alias("j")
    occupied = placed.groupBy("label", *home).agg(F.count("*").alias("held"))
    occupied = common.written(
        occupied.withColumn("blocks", F.ceil(F.col("held") / block).cast("int")), "near-occupied"
    )
    all_cells = F.concat(F.array(F.struct(*home)), F.col("visited"))
    visits = placed.select("cid", "label", "n", "vec", "hi", "hj", F.explode(all_cells).alias("cell"))
    visits = visits.select("cid", "label", "n", "vec", "hi", "hj", "cell.i", "cell.j")
    # Cells without a vector are not worth a visit; the number of visitors cuts crowded ones.
    crowd = visits.select("label", "i", "j").groupBy("label", "i", "j").agg(F.count("*").alias("asked"))
    occupied = occupied.join(crowd, ["label", "i", "j"]).withColumn(
        "tasks", F.ceil(F.col("asked") / visitors).cast("int")
    )
    occupied = common.bounded(common.written(occupied.drop("held", "asked"), "near-crowds"))
    spot = F.xxhash64("cid")
    # Names of their own, as both sides come from one table.
    own = placed.select(*(F.col(c).alias(c) for c in ("cid", "label", "n", "vec")), *home)
    homes = own.join(occupied, ["label", "i", "j"]).select(
        "cid", "label", "n", "vec", "i", "j",
        F.pmod(spot, F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"),
    )
    guests = visits.join(occupied, ["label", "i", "j"]).select(
        "cid", "label", "n", "vec", "hi", "hj", "i", "j",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("cid", F.lit(1)), F.col("tasks")).cast("int").alias("task"),
    )
    keys = ["label", "i", "j", "block", "task"]
    found = homes.groupBy(*keys).cogroup(guests.groupBy(*keys)).applyInPandas(
        lambda a, b: _linked(a, b, grid, dimension, most, threshold), "a binary, b binary, links long"
    )
    found = common.written(found, "near-links")
    counted = found.filter("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("linked"))
    joined = graph.components(found.filter("b is not null").select("a", "b"))
    joined = joined.select(F.col("node").alias("cid"), "component")
    whole = classes.select("cid", "n", "least").join(counted, "cid", "left").join(joined, "cid", "left")
    whole = whole.filter("linked is not null or n > 1").withColumn("component", F.coalesce("component", "cid"))
    least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    return whole.join(least, "component").select(
        "cid", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
