import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import curves



def table(spark, rows):
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return data.selectExpr("*", "1 AS cid", "2 AS v", "3 AS role")


def usable(vector):
    return vector is not None and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def brute(rows, k):
    good = {(i, tuple(v)) for i, v in rows if i is not None and usable(v)}
    good = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in good]
    out = {}
    for i, v in good:
        if i % 5 == 0:
            scores = sorted((-float(v @ w), j) for j, w in good if j != i)
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def found(data, **given):
    out = {}
    for r in sorted(curves.search(data, F.col("id") % 5 == 0, **given).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def same(got, expected):
    assert got.keys() == {q for q, hits in expected.items() if hits}
    for q, hits in got.items():
        assert [i for i, _ in hits] == [i for i, _ in expected[q]]
        assert [s for _, s in hits] == pytest.approx([s for _, s in expected[q]], abs=1e-9)


def random_rows(n, dimension=16, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(n, dimension)))]


def test_small_tables_are_searched_whole(spark):
    rows = random_rows(300)
    same(found(table(spark, rows), k=10), brute(rows, 10))


def test_odd_rows(spark):
    rows = random_rows(40, 4, 1)
    rows += [(100, None), (101, [0.0] * 4), (102, [1.0, None, 0.0, 0.0]), (103, [float("nan"), 1.0, 0.0, 0.0])]
    rows += [(104, [float("inf"), 1.0, 0.0, 0.0]), (None, [1.0] * 4), (5, rows[5][1]), (105, [-0.0, 0.0, 0.0, 0.0])]
    rows += [(200 + i, [3.0, 1.0, 0.0, 0.0]) for i in range(60)]
    same(found(table(spark, rows), k=10), brute(rows, 10))


def test_other_lengths_take_no_part(spark):
    rows = random_rows(40, 4, 1)
    odd = [(100, [1.0, 2.0]), (105, [1.0, 2.0]), (110, [1.0] * 7), (115, [])]
    same(found(table(spark, rows + odd), k=10), brute(rows, 10))
    short = [(100, [1.0, 2.0]), (105, [1.0, 2.0])]
    same(found(table(spark, rows + odd), k=10, dimension=2), brute(short, 10))
    assert found(table(spark, rows), dimension=3) == {}


def test_fewer_candidates_and_none(spark):
    rows = random_rows(4, 3, 2)
    same(found(table(spark, rows), k=10), brute(rows, 10))
    assert found(table(spark, [(0, [1.0, 2.0])])) == {}
    assert found(table(spark, [])) == {}


def test_recall_with_windows(spark):
    """Vectors without structure, the hardest case, and windows much smaller than the table."""
    rows = random_rows(6000, 32, 3)
    rows = [(i, v) for i, v in rows]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in curves.search(data, F.col("id") % 50 == 0, k=10, least_window=1).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    vectors = np.array([v for _, v in rows])
    hits = 0
    for q in range(0, 6000, 50):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-scores)[:10].tolist()))
    assert hits / (120 * 10) >= 0.9


def recall(spark, vectors, asked, k=20, **given):
    """Share of the true neighbours of the asked ids that the search finds; ids are row numbers."""
    data = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>")
    got = {}
    for r in curves.search(data, F.col("id").isin(asked), k=k, **given).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in asked:
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len(got.get(q, set()) & set(np.argsort(-scores)[:k].tolist()))
    return hits / (len(asked) * k)


def unit_vectors(n, dimension, seed):
    found = np.random.default_rng(seed).normal(size=(n, dimension))
    return found / np.linalg.norm(found, axis=1, keepdims=True)


@pytest.mark.parametrize("noise", [1e-4, 1e-3])
def test_recall_in_a_dense_group(spark, noise):
    """A third of the vectors lies around one centre, closer than any cell of a coarse key."""
    vectors = unit_vectors(30_000, 32, 4)
    group = vectors[0] + noise * unit_vectors(10_000, 32, 5)
    vectors[:10_000] = group / np.linalg.norm(group, axis=1, keepdims=True)
    assert recall(spark, vectors, list(range(0, 10_000, 250)), least_window=1) >= 0.9


def test_recall_beside_one_long_vector(spark):
    vectors = unit_vectors(30_000, 48, 7)
    vectors[5] *= 100
    assert recall(spark, vectors, list(range(0, 30_000, 750)), least_window=1) >= 0.9


def test_recall_with_uneven_norms(spark):
    """Norms over many bands, thin ones of very long and very short vectors among them."""
    rng = np.random.default_rng(8)
    vectors = unit_vectors(20_000, 32, 9) * np.exp(rng.normal(scale=0.5, size=(20_000, 1)))
    vectors[:8] *= 10.0 ** np.arange(-4, 4)[:, None]
    assert recall(spark, vectors, list(range(0, 20_000, 500)) + [1, 7]) >= 0.9


def test_recall_of_the_window_share(spark):
    """Unit vectors without structure and blocks so small that they do not widen the windows."""
    vectors = unit_vectors(30_000, 64, 10)
    assert recall(spark, vectors, list(range(0, 30_000, 500)), least_window=1, block=32) >= 0.9


def test_blocks_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(curves, "TASK_QUERIES", 7)
    rows = [(i, [x * 1.5 ** (i % 40 - 20) for x in v]) for i, v in random_rows(300)]
    rows += [(1001, [1e-30] + [0.0] * 15), (1005, [1e30] + [0.0] * 15)]
    expected = brute(rows, 10)
    got = found(table(spark, rows), k=10)
    assert {q: [i for i, _ in hits] for q, hits in got.items()} == {q: [i for i, _ in hits] for q, hits in expected.items()}


def test_equal_keys_in_another_order_on_each_curve(spark):
    """Vectors that no key can tell apart: queries see other vectors on each curve."""
    rows = [(i, [1.0, 1e-13 * i]) for i in range(40)]
    data = spark.createDataFrame(rows, "cid long, v array<double>").selectExpr(
        "*", "1 AS nth", "1.0D AS norm", "cid = 0 AS asked"
    )
    lined = curves._placed(data, [(0, 0, 1.0, 40)], 2, F.col("asked"), 1)
    lined = curves._positions(lined).collect()
    orders = {tuple(r.cid for r in sorted(lined, key=lambda r: r.position) if (r.curve, r.role) == (c, 0)) for c in range(16)}
    assert len(orders) > 8
    assert len({r.position for r in lined if r.role == 1}) > 4


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_key_bytes_follow_the_keys(dimensions, bits):
    cells = np.random.default_rng(6).integers(0, 1 << bits, (200, dimensions))
    keys = curves.hilbert_keys(cells, bits)
    packed = [bytes(row) for row in curves.key_bytes(cells, bits)]
    assert [keys[i] for i in sorted(range(200), key=lambda i: packed[i])] == sorted(keys.tolist())


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours_in_turn(dimensions, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dimensions), -1).reshape(-1, dimensions)
    keys = curves.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(side**dimensions))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()
