import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).parent))
from vectors import edge_rows, frame, groups  # noqa: E402

from tidemark.llm import whitening  # noqa: E402


def scatter(x):
    away = x - x.mean(0)
    return away.T @ away


def check(spectrum, x):
    size = max(1.0, np.abs(scatter(x)).max())
    upright = spectrum.vectors.T @ spectrum.vectors
    assert np.abs(upright - np.eye(len(upright))).max() < 1e-11
    again = (spectrum.vectors * spectrum.values) @ spectrum.vectors.T
    assert np.abs(again - scatter(x)).max() < 1e-11 * size
    assert spectrum.n == len(x)
    assert np.allclose(spectrum.mean, x.mean(0))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 7), st.lists(st.lists(st.integers(-3, 3), min_size=7, max_size=7), min_size=1, max_size=25))
def test_rank_one_updates(dimension, rows):
    """Small integers repeat rows and eigenvalues, so deflation has all its cases."""
    x = np.array(rows, float)[:, :dimension]
    own = whitening.Spectrum.empty(dimension)
    for row in x:
        own.add(row[None, :])
    check(own, x)


def test_merge_of_spectra():
    rng = np.random.default_rng(1)
    x = np.vstack([groups(rng, 5, 9, 20, 0.01), 1000 + rng.normal(size=(40, 9))])
    parts = []
    for some in np.array_split(x, 4):
        part = whitening.Spectrum.empty(9)
        part.add(some)
        parts.append(part)
    for other in parts[1:]:
        parts[0].merge(other)
    check(parts[0], x)


def test_secular_roots_interlace():
    rng = np.random.default_rng(2)
    d = np.sort(rng.normal(size=30))
    d[10] = d[9] + 1e-9
    z = rng.normal(size=30)
    z[4] = 1e-7
    gap, roots = whitening.secular_roots(d, z)
    expected = np.linalg.eigvalsh(np.diag(d) + np.outer(z, z))
    assert np.abs(roots - expected).max() < 1e-13 * 30
    assert (np.diff(roots) > 0).all()
    assert (gap < 0).sum() == 30 * 31 // 2


def brute(rows, dimension, components=32):
    good = [r for r in rows if r[1] and len(r[1]) == dimension and all(c is not None and np.isfinite(c) for c in r[1])]
    x = np.floor(64 * np.array([r[1] for r in good], float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    away = (x - s // n) - (s % n) / n
    values, vectors = np.linalg.eigh(away.T @ away / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return [r[0] for r in good], ((n * x - s) ** 2).sum(1), away @ vectors / np.sqrt(values), values / values.sum()


def whitened(data, **given):
    rows = whitening.whiten(data, **given).collect()
    return sorted(map(tuple, rows), key=lambda r: (r[0], r[3], r[1]))


@pytest.mark.parametrize("parts", [1, 40])
def test_equals_brute_force(spark, parts):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)) * [8, 5, 3, 2, 1, 0.5]
    rows = [(at, v.tolist(), 0) for at, v in enumerate(x)] + edge_rows()
    ids, deviations, white, share = brute(rows, 6)
    got = whitened(frame(spark, rows).repartition(parts))
    assert len(got) == len(ids) * 6
    # Repeated rows have equal results, so one entry stands for them.
    held = {(r[0], r[1]): r[4] for r in got}
    found = np.array([[held[i, c] for c in range(1, 7)] for i in ids])
    sign = np.sign((found * white).sum(0))
    assert np.abs(found * sign - white).max() < 1e-9
    assert sorted((r[0], r[3]) for r in got if r[1] == 1) == sorted(zip(ids, deviations.tolist(), strict=True))
    assert {r[2] for r in got} == {len(ids)}
    assert np.allclose(sorted({r[5] for r in got})[::-1], share, rtol=1e-9)
    assert max(r[6] for r in got) < 1e-9


def test_residuals_widen_the_basis(spark):
    """More dimensions than the first basis holds, from a start that knows nothing."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 24)) * np.linspace(1, 30, 24)
    rows = [(at, v.tolist(), 0) for at, v in enumerate(x)]
    entries, dimension = whitening.entries(frame(spark, rows), "vec_id", "embedding")
    n, sums = whitening._exact_sums(entries, dimension)
    start = np.eye(24)[:, :4]
    values, vectors, trace = whitening.refine(entries, dimension, whitening.Centred(n, sums), start, 2)
    away = np.floor(64 * x) - np.floor(64 * x).mean(0)
    expected, right = np.linalg.eigh(away.T @ away / n)
    assert np.allclose(values, expected[::-1][:2], rtol=1e-12)
    assert trace == pytest.approx(expected.sum(), rel=1e-12)
    assert np.allclose(np.abs((vectors * right[:, ::-1][:, :2]).sum(0)), 1, atol=1e-12)


def test_without_variance(spark):
    assert whitened(frame(spark, edge_rows()).limit(0)) == []
    assert whitened(frame(spark, [(1, [1.0, 2.0], 0)])) == []
    assert whitened(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, None, 0)])) == []
    # One direction of two has a variance.
    got = whitened(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 4.0], 0)]))
    assert [(r[0], r[1], abs(round(r[4], 12)), r[3]) for r in got] == [(1, 1, 1.0, 128**2), (2, 1, 1.0, 128**2)]


def test_deviation_beyond_a_long(spark):
    rows = [(at, [float(at % 2) * 1e12, 1.0], 0) for at in range(8)]
    assert {r[3] for r in whitened(frame(spark, rows))} == {None}
