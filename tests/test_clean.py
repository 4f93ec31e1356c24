from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import dates
from tidemark.operators import clean


@pytest.fixture
def raw(spark):
    def make(rows):
        return spark.createDataFrame(rows, schemas.RAW_BARS)

    return make


def row(day, ticker="AAA", close=10.0, volume=5.0):
    return (day, ticker, 9.0, 11.0, 8.0, close, volume)


def test_canonical_dates_and_order(raw):
    texts = ["2026-06-02", "2026-06-01(2)", "2026-06-01", "2026-06-01 07:00:00", "2026-06-01(1)"]
    out = clean.canonical_dates(raw([row(t) for t in texts])).orderBy("date")
    assert [r.date for r in out.collect()] == [
        "2026-06-01",
        "2026-06-01",
        "2026-06-01(1)",
        "2026-06-01(2)",
        "2026-06-02",
    ]


def test_text_and_typed_keys_sort_alike(raw):
    texts = ["2026-06-01(2)", "2026-06-02", "2026-06-01", "2026-06-01(1)", "2025-12-31(2)"]
    typed = clean.typed(raw([row(t) for t in texts])).withColumn(
        "key", dates.session_key(F.col("trade_date"), F.col("session"))
    )
    by_text = [r.key for r in typed.orderBy("key").collect()]
    assert by_text == [r.key for r in typed.orderBy("trade_date", "session").collect()]
    assert sorted(texts) == by_text


def test_unreadable_dates_are_quarantined(raw):
    data = raw([row("junk"), row(None), row("2026-13-45"), row("2026-06-01(1)")])
    assert {r.date for r in clean.quarantine(data).collect()} == {"junk", None, "2026-13-45"}
    assert clean.clean(data).count() == 1


def test_strip_marker_reads_mixed_forms(raw):
    texts = ["2026-06-01", "2026-06-01(2)", "2026-06-01 09:15:00", "nothing"]
    out = {r.date: r.trade_date for r in clean.with_plain_date(raw([row(t) for t in texts])).collect()}
    assert out == {t: date(2026, 6, 1) for t in texts[:3]} | {"nothing": None}


@pytest.mark.parametrize("position", range(len(schemas.RAW_BARS)))
def test_a_null_in_any_column_drops_the_row(raw, position):
    broken = list(row("2026-06-01", "BBB"))
    broken[position] = None
    kept = clean.clean(raw([row("2026-06-01"), tuple(broken)])).collect()
    assert [r.ticker for r in kept] == ["AAA"]


def test_conflicting_rows_leave_one_per_key(raw):
    data = raw(
        [row("2026-06-01", close=10.0), row("2026-06-01 07:00:00", close=12.0), row("2026-06-01(1)")]
    )
    kept = clean.clean(data).orderBy("session").collect()
    assert [(r.session, r.close) for r in kept] == [(0, 12.0), (1, 10.0)]


def test_collapse_prefers_whole_day_bar(make_bars):
    bars = make_bars(
        [
            ("AAA", 0, 1, 10, 12, 9, 11, 5),
            ("AAA", 0, 2, 11, 15, 10, 14, 7),
            ("BBB", 0, 0, 1, 2, 0.5, 1.5, 3),
            ("BBB", 0, 1, 8, 9, 7, 8, 4),
        ]
    )
    out = {r.ticker: r for r in clean.collapse_sessions(bars).collect()}
    a, b = out["AAA"], out["BBB"]
    assert (a.open, a.high, a.low, a.close, a.volume) == (10, 15, 9, 14, 12)
    assert (b.open, b.high, b.low, b.close, b.volume) == (1, 2, 0.5, 1.5, 3)


def test_profile_counts_each_step(raw):
    data = raw(
        [
            row("2026-06-01"),
            row("2026-06-01 07:00:00"),
            row("junk"),
            row("2026-06-02", "BBB"),
            row("2026-06-02", "BBB", volume=None),
        ]
    )
    got = clean.profile(data).first().asDict()
    assert got == {
        "rows": 5,
        "tickers": 2,
        "columns": 7,
        "rows_without_nulls": 3,
        "rows_distinct": 2,
        "removed_nulls": 2,
        "removed_duplicates": 1,
    }
