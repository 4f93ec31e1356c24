"""Connected components of an undirected graph, as joins and grouped minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

ROUNDS = 100
# So many edges at most are settled by one task; more by joins.
TASK_EDGES = 500_000


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node of its component, for nodes on edges ``a, b``.

    Alternates two steps that hang nodes below ever smaller ones: each node links its
    larger neighbours to its smallest, then each node links all its smaller ones to
    the smallest. Ends when every node hangs below a root. Every round is written to the
    shared folder. Loops and repeated edges are ignored. Up to ``TASK_EDGES`` edges, some tens of
    megabytes, need no rounds: one task has room for them.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = common.written(edges.distinct(), "edges")
    if edges.count() <= TASK_EDGES:
        kind = edges.schema["a"].dataType.simpleString()
        return common.mapped(edges.coalesce(1), _settled_at_once, f"node {kind}, component {kind}")
    for _ in range(ROUNDS):
        if _settled(edges):
            break
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").select(
            F.explode(
                F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
            ).alias("e")
        )
        edges = common.written(hung.select("e.*").filter("a <> b").distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs below one other, which itself hangs below none."""
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("node"), F.lit(1).alias("under"), F.lit(0).alias("over")),
            F.struct(F.col("b").alias("node"), F.lit(0).alias("under"), F.lit(1).alias("over")),
        )
    ).alias("e")
    nodes = edges.select(ends).select("e.*").groupBy("node").agg(
        F.sum("under").alias("under"), F.max("over").alias("over")
    )
    return nodes.filter("under > 1 or under = 1 and over = 1").isEmpty()


def _settled_at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of edges that one task holds: trees are joined until none can be."""
    edges = list(batches)
    if not edges:
        return
    table = pa.Table.from_batches(edges)
    ends = [table.column(name).combine_chunks() for name in ("a", "b")]
    nodes = pc.unique(pa.chunked_array(ends).combine_chunks())
    nodes = nodes.take(pc.sort_indices(nodes))
    a, b = (pc.index_in(end, nodes).to_numpy(zero_copy_only=False).astype(np.int64) for end in ends)
    parent = join(np.arange(len(nodes)), a, b)
    yield common.record(pa.schema([("node", nodes.type), ("component", nodes.type)]), nodes, nodes.take(pa.array(parent)))


def join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the trees of linked nodes in place; each node's parent becomes the smallest of its tree."""
    while len(a):
        left, right = parent[a], parent[b]
        differ = left != right
        a, b, left, right = a[differ], b[differ], left[differ], right[differ]
        np.minimum.at(parent, np.maximum(left, right), np.minimum(left, right))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
    return parent
