from __future__ import annotations

import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark import schemas  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources import store  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "6g")
    store.ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def path(spark):
    """Fresh paths under the shared folder."""
    return lambda name: store.new_path(spark, f"test-{name}")


@pytest.fixture(scope="session")
def make_bars(spark):
    """Typed bars from (ticker, day number, session, open, high, low, close, volume)."""

    def make(rows):
        start = date(2026, 1, 5)
        full = [
            (ticker, start + timedelta(days=day), session, *map(float, values))
            for ticker, day, session, *values in rows
        ]
        return spark.createDataFrame(full, schemas.BARS)

    return make


@pytest.fixture(scope="session")
def flat_series(make_bars):
    """Daily bars of one ticker from a list of closes (open = high = low = close)."""

    def make(closes, ticker="AAA", volumes=None):
        volumes = volumes or [100.0] * len(closes)
        return make_bars(
            [(ticker, i, 0, c, c, c, c, v) for i, (c, v) in enumerate(zip(closes, volumes, strict=True))]
        )

    return make
