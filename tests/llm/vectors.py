"""Vector tables for tests: nulls, zeros, bad components, ties, repeats, clashing columns."""

from __future__ import annotations

import numpy as np

CLASHING = ("cid", "v", "n", "i", "j", "x", "least", "block", "task", "rank", "component", "score", "id", "Label_")


def frame(spark, rows):
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return data.selectExpr("*", *(f"{at} AS {name}" for at, name in enumerate(CLASHING)))


def edge_rows(dimension=6):
    nan, inf = float("nan"), float("inf")
    one = [0.5] * dimension
    return [
        (901, None, 1),
        (902, [0.0] * dimension, 1),
        (903, [nan, *one[1:]], 1),
        (904, [inf, *one[1:]], 1),
        (905, [None, *one[1:]], 1),
        (906, one, None),
        (907, one, 1),
        (908, one, 1),
        (908, one, 1),
        (909, [-0.0, *one[1:]], 2),
        (910, [0.0, *one[1:]], 2),
        (911, [0.5], 1),
        (912, [], 1),
    ]


def groups(rng, count, dimension, copies, noise):
    """Rows of which some are near a common centre."""
    out = []
    for at in range(count):
        base = rng.normal(size=dimension)
        for _ in range(copies):
            out.append(base + noise * rng.normal(size=dimension))
    return np.array(out)
