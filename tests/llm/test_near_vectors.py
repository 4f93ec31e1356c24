import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from vectors import edge_rows, frame, groups  # noqa: E402

from tidemark.llm import near_vectors  # noqa: E402


def brute(rows, threshold=0.98):
    """Links and components of the rows by comparing all pairs; rows are numbered."""
    good = [
        at
        for at, (_, v, label) in enumerate(rows)
        if label is not None and v and len(v) > 1 and all(c is not None and np.isfinite(c) for c in v) and any(v)
    ]
    near = {at: set() for at in range(len(rows))}
    for a in good:
        for b in good:
            if a != b and rows[a][2] == rows[b][2]:
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    near[a].add(b)
    out = []
    for at, (vec_id, _, _) in enumerate(rows):
        seen, open_ = {at}, [at]
        while open_:
            for b in near[open_.pop()] - seen:
                seen.add(b)
                open_.append(b)
        least = min(rows[b][0] for b in seen)
        out.append((vec_id, len(near[at]), least, vec_id == least))
    return sorted(out)


def found(data, **given):
    return sorted(map(tuple, near_vectors.near_copies(data, **given).collect()))


def test_edges_and_repeats(spark):
    rng = np.random.default_rng(1)
    x = groups(rng, 12, 6, 6, 0.06)
    rows = [(at, v.tolist(), at % 2) for at, v in enumerate(x)] + edge_rows()
    assert found(frame(spark, rows)) == brute(rows)
    # The rule does not depend on how cells are cut.
    assert found(frame(spark, rows), block=3, visitors=4) == brute(rows)


def test_huge_and_tiny_vectors(spark):
    rows = [(1, [1e300, 1e300], 0), (2, [1e-300, 1e-300], 0), (3, [3.0, 3.1], 0), (4, [-1.0, 1.0], 0)]
    assert found(frame(spark, rows)) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]


def test_one_group_of_a_third_of_the_rows(spark):
    rng = np.random.default_rng(2)
    near = groups(rng, 1, 16, 300, 0.03)
    rest = rng.normal(size=(600, 16))
    rows = [(at, v.tolist(), 3) for at, v in enumerate(np.vstack([near, rest]))]
    assert found(frame(spark, rows), block=64, visitors=50) == brute(rows)


def test_target_recall(spark):
    """Of chains and groups at the very threshold the traversal finds all, with many small cells."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    turn = rng.normal(size=base.shape)
    turn -= (turn * base).sum(1)[:, None] * base
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    angle = np.arccos(0.9801)
    pairs = np.vstack([base, np.cos(angle) * base + np.sin(angle) * turn])
    rows = [(at, v.tolist(), 0) for at, v in enumerate(pairs)]
    links = {r[0]: r[1] for r in found(frame(spark, rows))}
    expected = {r[0]: r[1] for r in brute(rows)}
    lost = sum(links[i] != n for i, n in expected.items())
    assert sum(expected.values()) >= 800
    assert lost <= 0.001 * len(rows)


def test_empty_and_unusable(spark):
    assert found(frame(spark, [(1, [1.0], 0)]).limit(0)) == []
    assert found(frame(spark, [(1, None, 0), (2, [0.0], 0)])) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_reach():
    assert near_vectors.reach(4, 0.98, 0.9999) == pytest.approx(0.04)
    assert near_vectors.reach(64, 0.98, 0.9999) < 0.04 * 0.3
