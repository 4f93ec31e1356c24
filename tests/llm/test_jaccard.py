import random
import re
import string
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import graph, jaccard

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(
        ((key, len(sets[i]), least.get(find(i), key) if sets[i] else key) for i, (key, _) in enumerate(rows)), key=str
    )


def result(data):
    return sorted((tuple(r) for r in jaccard.components(data).collect()), key=str)


def near_copies(seed, groups=25):
    rng = random.Random(seed)
    words = [f"w{i}é" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 5, 8, 12, 13, 15, 20, 25, 40, 60, 100, 250]))
        for _ in range(rng.randint(1, 10)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
                if rng.random() < 0.3:
                    copy.insert(rng.randrange(len(copy)), rng.choice(words))
            rows.append((len(rows) * 7 % 1009, " ".join(copy).upper() if rng.random() < 0.2 else "\t".join(copy)))
    return rows


def test_near_copies(documents):
    rows = near_copies(1)
    assert result(documents(rows)) == brute(rows)


def test_one_large_group(documents):
    """Copies that link only through others, more of them than the first rounds compare."""
    rng = random.Random(2)
    words = [f"v{i}" for i in range(300)]
    base = rng.choices(words, k=120)
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((1000 - i, " ".join(copy)))
    assert result(documents(rows)) == brute(rows)


def test_edges(documents, edge_rows):
    assert result(documents(edge_rows)) == brute(edge_rows)
    assert result(documents([])) == []


def test_without_broadcast(documents, monkeypatch):
    from tidemark.llm import common

    monkeypatch.setattr(common, "BROADCAST_IDS", -1)
    rows = near_copies(3, groups=6)
    assert result(documents(rows)) == brute(rows)


def test_sets_match_words():
    texts = ["A b c d", "a  B\tc\nd", "a", "", "a b", "b a", "a b c a b c", "é É x"]
    sets = jaccard.shingle_sets(pa.array(texts), 3)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (sets[i].tolist() == sets[j].tolist()) == (shingles(a) == shingles(b))


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)
        b = rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)
        a, b = np.unique(jaccard.mixed(a)), np.unique(jaccard.mixed(b))
        apart = len(np.setxor1d(a, b))
        for words in (1, 4, 16):
            sketches = jaccard.parity(a, words) ^ jaccard.parity(b, words)
            assert sum(int(x).bit_count() for x in sketches) <= apart


def test_linked_sets_share_a_block():
    """For every size and the largest difference that still links."""
    rng = np.random.default_rng(5)
    threshold = jaccard.Threshold(90)
    for n in [*range(1, 60), 100, 333, 1000]:
        tokens = jaccard.mixed(rng.integers(0, 2**62, n + n // 9 + 2).astype(np.uint64))
        for more in range(n // 9 + 1):
            a, b = np.unique(tokens[:n]), np.unique(tokens[: n + more])
            if 100 * len(a) < 90 * len(b):
                continue
            shared = set(jaccard.block_keys(a, threshold).tolist()) & set(jaccard.block_keys(b, threshold).tolist())
            assert shared, (n, more)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_the_keys_that_they_need(percent):
    """Differences on both sides, up to the most that still link; unrelated sets share none."""
    rng = np.random.default_rng(6)
    threshold = jaccard.Threshold(percent)
    for n in [*range(1, 40), 64, 100, 333, 1000, 4000]:
        tokens = np.unique(jaccard.mixed(rng.integers(0, 2**62, 2 * n + 2).astype(np.uint64)))
        rng.shuffle(tokens)
        for gone in sorted({0, n // 40, n // 20, n // 10, n // 5}):
            for more in sorted({0, n // 40, n // 20, n // 10, n // 4}):
                a, b = np.sort(tokens[:n]), np.sort(tokens[gone : n + more])
                union = len(np.union1d(a, b))
                if not len(b) or 100 * len(np.intersect1d(a, b)) < percent * union:
                    continue
                shared = len(np.intersect1d(jaccard.block_keys(a, threshold), jaccard.block_keys(b, threshold)))
                assert shared >= max(threshold.need(len(a)), threshold.need(len(b))) > 0, (n, gone, more)


def test_likely_sets(spark):
    """Sets that share too few keys go, and then those that shared their keys with them only."""
    blocks = [(k, s) for k in range(3) for s in (1, 2)] + [(9, 2), (9, 3), (8, 3), (8, 4), (7, 4), (7, 5)]
    needs = [(s, 2) for s in (1, 2, 3, 4)] + [(5, 2), (5, 2), (6, 1)]
    rows, weights = jaccard.likely(
        jaccard.common.written(spark.createDataFrame(blocks, "key long, sid long"), "members"),
        spark.createDataFrame(needs, "sid long, share long"),
    )
    assert sorted(map(tuple, rows.collect())) == [(k, s) for k in range(3) for s in (1, 2)]
    assert {1, 2} <= {r.sid for r in weights.collect()} and 5 not in {r.sid for r in weights.collect()}


@pytest.mark.parametrize("apart", [True, False])
def test_rarest(spark, apart):
    """Sets that share too little with other components go; the rarest shingles are enough for the rest."""
    sets = [(1, list(range(10))), (2, [*range(9), 20]), (3, [*range(7), 30, 31, 32])]
    members = [(1, 5, 1), (2, 5, 2 if apart else 1), (3, 5, 3), (3, 5, 3)]
    got = jaccard._rarest(
        spark.createDataFrame(members, "sid long, weight long, component long"),
        spark.createDataFrame(sets, "sid long, tokens array<long>"),
        jaccard.Threshold(80),
    )
    assert sorted((r.key, r.sid) for r in got.collect()) == ([(7, 1), (7, 2), (8, 1), (8, 2)] if apart else [])


def test_differences_are_taken_once_a_set(documents, monkeypatch):
    """Copies and texts that are nearly copies: few sets move their differences, each for few leaders."""
    rng = random.Random(8)
    rows = []
    for group in range(4):
        base = [f"g{group}x{i}" for i in range(150)]
        for edits in [1] * 12 + [3, 4, 6, 7, 8, 9, 10, 11] * 2:
            copy = list(base)
            for place in rng.sample(range(150), edits):
                copy[place] = f"n{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(copy)))
    taken, before = [], jaccard._differences

    def counted(members, *rest):
        taken.append(members.filter("sid <> lead").select("lead", "sid").distinct().count())
        return before(members, *rest)

    monkeypatch.setattr(jaccard, "_differences", counted)
    assert result(documents(rows)) == brute(rows)
    assert sum(taken) <= len(rows)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("most", [0, graph.TASK_EDGES])
def test_components(spark, seed, most, monkeypatch):
    """By joins and in one task."""
    monkeypatch.setattr(graph, "TASK_EDGES", most)
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {n: find(n) for e in edges if e[0] != e[1] for n in e}
    assert {r.node: r.component for r in got} == expected and len(got) == len(expected)
    none = graph.components(spark.createDataFrame([(1, 1)], "a long, b long"))
    assert none.isEmpty() and none.columns == ["node", "component"]


@pytest.mark.parametrize("top", [3, 1 << 20, 1 << 52])
def test_coded_numbers(top):
    rng = np.random.default_rng(top)
    for n in (1, 2, 500):
        values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        got, rest = jaccard.decoded(jaccard.coded(values) + b"rest", n)
        assert (got == values).all() and rest == b"rest"


def test_shared_blocks_are_those_of_several_sets(spark, documents):
    """Chunks and ranges of any size find the same keys; copies of a set share none."""
    data = near_copies(3)
    source = documents(data + data[:5]).select("doc_id", "text").repartition(7)
    threshold = jaccard.Threshold(90)
    sets = {tuple(s.tolist()): s for _, t in data for s in jaccard.shingle_sets(pa.array([t]), 3) if len(s)}
    held = defaultdict(set)
    for s in sets.values():
        for key in jaccard.block_keys(s, threshold).view(np.uint64):
            held[int(key >> np.uint64(24))].add(jaccard._set_id(s))
    expected = {(key, sid) for key, sids in held.items() if len(sids) > 1 for sid in sids}
    got = {(r.key, r.sid) for r in jaccard.shared_blocks(source, 3, threshold, 1000).collect()}
    assert expected and got == expected
