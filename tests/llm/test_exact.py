import hashlib
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[(text or "").translate(LOWER)].append(key)
    out = Counter()
    for body, keys in groups.items():
        keep = max((k for k in keys if k is not None), default=None)
        sha = hashlib.sha256(body.encode()).hexdigest()
        first = True
        for key in keys:
            kept = key == keep and first
            first = first and not kept
            out[key, keep, len(keys), kept, sha] += 1
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_filter_never_rejects_its_keys(n):
    rng = np.random.default_rng(n)
    keys, others = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**63, 20_000).astype(np.uint64)
    built = exact.FuseFilter.build(keys)
    assert built.may_hold(keys).all()
    assert built.may_hold(others).mean() < 0.02
    if n >= 50_000:
        assert len(built.slots) < 1.3 * n


# With 1 and 0 bytes of digest, nearly all and all texts collide.
@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_groups(documents, edge_rows, digest_bytes):
    rows = edge_rows + [(10, "A b"), (11, "a B"), (12, "É"), (13, "é"), (14, "A B")]
    got = exact.dedup(documents(rows), digest_bytes=digest_bytes)
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_snapshot_and_batch_split_changes_nothing(documents, edge_rows):
    rows = edge_rows + [(i, f"text {i % 7}") for i in range(20, 60)]
    for fresh in (F.lit(True), F.lit(False), F.col("doc_id") % 3 == 0):
        assert Counter(map(tuple, exact.dedup(documents(rows), fresh).collect())) == brute(rows)


def test_the_filter_decides_what_the_snapshot_holds(documents, monkeypatch):
    """Without what filters let through, only repeats inside the batch and the snapshot are found."""
    rows = [(0, "both"), (1, "both"), (2, "old"), (4, "old"), (3, "new"), (5, "new"), (6, "one")]
    fresh = F.col("doc_id") % 2 == 1
    assert Counter(map(tuple, exact.dedup(documents(rows), fresh).collect())) == brute(rows)
    monkeypatch.setattr(
        exact, "screen", lambda new, filters: new.select("bucket", "digest", F.lit(False).alias("maybe"))
    )
    got = Counter(map(tuple, exact.dedup(documents(rows), fresh).collect()))
    apart = brute([r for r in rows if r[0] != 1]) + brute([(1, "both")])
    assert got == apart


def test_without_broadcast(documents, edge_rows, monkeypatch):
    monkeypatch.setattr(exact, "BROADCAST_DIGESTS", -1)
    assert Counter(map(tuple, exact.dedup(documents(edge_rows)).collect())) == brute(edge_rows)


def test_empty_table(documents):
    assert exact.dedup(documents([])).count() == 0


def test_keep(documents, edge_rows):
    data = documents(edge_rows)
    got = exact.keep(data)
    assert got.columns == data.columns
    expected = Counter(
        (r[0], r[4]) for r in brute(edge_rows).elements() if r[3]
    )
    shas = Counter(
        (r.doc_id, hashlib.sha256((r.text or "").translate(LOWER).encode()).hexdigest()) for r in got.collect()
    )
    assert shas == expected
