import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_fit_alone(counts, capacity):
    """Sequences of plain best-fit decreasing, one piece at a time."""
    gaps = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fit = min((g for g in gaps if g >= length), default=None)
        if fit is None:
            gaps.append(capacity - length)
        else:
            gaps[gaps.index(fit)] -= length
    return len(gaps)


def check_plan(counts, capacity):
    plan = packing.make_plan(counts, capacity)
    fill, used = defaultdict(list), defaultdict(int)
    for length, low, copies, offset, first, times in plan.rows:
        assert low == used[length]
        used[length] += copies * times
        for sequence in range(first, first + times):
            fill[sequence] += [(offset + i * length, length) for i in range(copies)]
    assert dict(used) == {x: n for x, n in counts.items() if n}
    assert sorted(fill) == list(range(plan.sequences))
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return plan.sequences


@pytest.mark.parametrize("seed", range(12))
def test_plans_are_whole_and_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 100])
    counts = {x: rng.randint(0, 6) for x in range(1, capacity + 1) if rng.random() < rng.choice([0.1, 0.5, 1])}
    assert check_plan(counts, capacity) <= best_fit_alone(counts, capacity)


def test_exact_complements():
    assert check_plan({2048: 3, 2000: 5, 48: 5, 1500: 2, 500: 2, 48 + 1: 0}, 2048) == 10
    assert check_plan({1000: 1, 500: 1, 300: 1, 248: 1}, 2048) == 1
    assert check_plan({}, 2048) == 0


def test_large_counts_are_cheap():
    assert packing.make_plan({1: 10**9, 2048: 10**8, 7: 123_456_789}).sequences == 10**8 + -(-(10**9 + 7 * 123_456_789) // 2048)


def test_cutting():
    assert packing.cut(1, 8) == [(0, 1)]
    assert packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(9, 8) == [(0, 1), (1, 8)]
    assert packing.cut(24, 8) == [(0, 8), (8, 8), (16, 8)]


@pytest.mark.parametrize("capacity", [16, 2048])
def test_operator(documents, edge_rows, capacity):
    rows = edge_rows + [(100 + i, "some words of a short text " * (i % 9)) for i in range(80)]
    got = packing.pack_documents(documents(rows), PATH, capacity).collect()
    library = Tokenizer.from_file(PATH)
    expected = []
    for key, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, (start, length) in enumerate(packing.cut(len(ids), capacity)):
            expected.append((key, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
    order = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(expected, key=order)
    fill = defaultdict(list)
    for r in got:
        fill[r.sequence_id].append((r.offset, r.length))
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity


def test_salted_ranks(spark):
    rows = spark.createDataFrame([(i, 5 if i % 3 else i % 11) for i in range(500)], "doc_id long, length long")
    got = packing.ranked(rows, ["doc_id"], salt_rows=20).collect()
    by_length = defaultdict(list)
    for r in got:
        by_length[r.length].append(r["rank"])
    assert all(sorted(ranks) == list(range(len(ranks))) for ranks in by_length.values())


def test_empty_table(documents):
    assert packing.pack_documents(documents([]), PATH).count() == 0
