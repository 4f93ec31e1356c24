import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from vectors import edge_rows, frame, groups  # noqa: E402

from tidemark.llm import hard_negatives, multi_index  # noqa: E402


def brute(rows, every):
    good = {
        (i, label, tuple(int(np.floor(256 * c)) for c in v))
        for i, v, label in rows
        if None not in (i, label, v) and len(v) == 6 and all(c is not None and np.isfinite(c) for c in v)
    }

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2], strict=True))

    out = []
    for a in good:
        if a[0] % every:
            continue
        ranked = sorted(good - {a}, key=lambda b: (-score(a, b), b[0]))
        for p in [b for b in ranked if b[1] == a[1]][:5]:
            top = score(a, p)
            window = [b for b in ranked if b[1] != a[1] and 80 * top <= 100 * score(a, b) <= 100 * top]
            for rank, q in enumerate(window[:5], 1):
                out.append((a[0], p[0], rank, q[0], top, score(a, q)))
    return sorted(out)


def found(data, every, **given):
    return sorted(map(tuple, hard_negatives.mine(data, F.col("id") % every == 0, **given).collect()))


SMALL = [{}, {"first": 1, "codewords": 3}, {"first": 20, "block": 7, "anchors": 3}, {"codewords": 1}]


@pytest.mark.parametrize("given", SMALL)
def test_equals_brute_force(spark, given):
    rng = np.random.default_rng(4)
    x = np.vstack([groups(rng, 15, 6, 6, 0.4), np.round(rng.normal(size=(60, 6)))])
    rows = [(at, v.tolist(), int(rng.integers(3))) for at, v in enumerate(x)] + edge_rows()
    expected = brute(rows, 3)
    assert len(expected) > 100
    assert found(frame(spark, rows), 3, **given) == expected


def test_many_copies(spark):
    """A third of all rows are one vector, in two labels."""
    rng = np.random.default_rng(5)
    same = [(at, [1.0] * 6, at % 2) for at in range(150)]
    rest = [(at, v.tolist(), at % 2) for at, v in enumerate(rng.normal(size=(300, 6)), 150)]
    assert found(frame(spark, same + rest), 50, block=16) == brute(same + rest, 50)


def test_large_components(spark):
    """Products beyond the exact integers of doubles."""
    rng = np.random.default_rng(6)
    rows = [(at, v.tolist(), at % 2) for at, v in enumerate(200_000 * rng.uniform(0.5, 1, size=(40, 6)))]
    assert found(frame(spark, rows), 10) == brute(rows, 10)


def test_empty_and_alone(spark):
    assert found(frame(spark, edge_rows()).limit(0), 1) == []
    assert found(frame(spark, [(1, None, 1)]), 1) == []
    assert found(frame(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)]), 1) == []


def test_heap_order():
    rng = np.random.default_rng(7)
    left, right = rng.normal(size=9), rng.normal(size=5)
    cells = list(multi_index.multi_sequence(left, right))
    assert sorted((i, j) for i, j, _ in cells) == [(i, j) for i in range(9) for j in range(5)]
    costs = [c for _, _, c in cells]
    assert costs == sorted(costs)
    assert all(c == left[i] + right[j] for i, j, c in cells)


def test_bounds_hold():
    """No vector of a cell scores more than the bound of the cell."""
    rng = np.random.default_rng(8)
    x = np.floor(256 * rng.normal(size=(500, 8)))
    grid = multi_index.fit(x, 6)
    i, j = grid.cells(x)
    left, right = grid.distances(x)
    held = {}
    for at in range(len(x)):
        n, a, b = held.get((i[at], j[at]), (0, 0.0, 0.0))
        held[i[at], j[at]] = (n + 1, max(a, left[at, i[at]] ** 0.5), max(b, right[at, j[at]] ** 0.5))
    index = hard_negatives.Index(grid, held)
    first, second = index.bounds(x[:50])
    assert (x[:50] @ x.T <= first[:, i] + second[:, j]).all()
