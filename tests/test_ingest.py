from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import dates
from tidemark.operators import ingest

TICKS = "ticker string, ts timestamp_ntz, event_id bigint, price double, volume bigint"


def tick(clock, price=1.0, number=0, ticker="AAA", volume=1):
    return (ticker, datetime.fromisoformat(f"2026-01-05 {clock}"), number, price, volume)


def test_session_edges(spark):
    clocks = ["08:59", "09:00", "11:30", "11:31", "13:29", "13:30", "15:00", "15:01"]
    ticks = spark.createDataFrame([tick(c, number=i) for i, c in enumerate(clocks)], TICKS)
    marks = ingest.with_session(ticks).orderBy("event_id").collect()
    assert [r.session for r in marks] == [2, 1, 1, 1, 1, 2, 2, 2]
    kept = ingest.session_ticks(ticks).orderBy("event_id").collect()
    assert [r.ts.strftime("%H:%M") for r in kept] == ["09:00", "11:30", "13:30", "15:00"]


def test_session_end_is_exact(spark):
    ticks = spark.createDataFrame([tick("11:30:00"), tick("11:30:00.000001")], TICKS)
    assert ingest.session_ticks(ticks).count() == 1


def test_utc_instants_are_read_at_the_exchange(spark):
    ticks = spark.createDataFrame([tick("02:30:00", number=1), tick("06:31:00", number=2)], TICKS)
    instants = ticks.withColumn("ts", F.col("ts").cast("timestamp"))
    marks = ingest.with_session(instants, dates.EXCHANGE_ZONE).orderBy("event_id").collect()
    assert [r.session for r in marks] == [1, 2]


def test_session_bars_follow_time_then_number(spark):
    ticks = spark.createDataFrame(
        [
            tick("09:30", 5.0, 3),
            tick("09:30", 4.0, 2),
            tick("10:00", 9.0, 4),
            tick("11:00", 2.0, 5),
            tick("14:00", 7.0, 6),
            tick("12:00", 99.0, 7),
        ],
        TICKS,
    )
    bars = ingest.session_bars(ticks).orderBy("session").collect()
    assert [(b.session, b.open, b.high, b.low, b.close, b.volume) for b in bars] == [
        (1, 4.0, 9.0, 2.0, 2.0, 4),
        (2, 7.0, 7.0, 7.0, 7.0, 1),
    ]


def raw(spark, rows):
    full = [(d, t, c, c, c, c, 1.0) for d, t, c in rows]
    return spark.createDataFrame(full, schemas.RAW_BARS)


def test_upsert_newest_wins_and_repeats_change_nothing(spark):
    old = raw(spark, [("2026-01-05", "AAA", 1.0), ("2026-01-06", "AAA", 2.0)])
    new = raw(spark, [("2026-01-06", "AAA", 3.0), ("2026-01-07", "AAA", 4.0)])
    once = ingest.upsert_keep_last(old, new)
    assert {(r.date, r.close) for r in once.collect()} == {
        ("2026-01-05", 1.0),
        ("2026-01-06", 3.0),
        ("2026-01-07", 4.0),
    }
    twice = ingest.upsert_keep_last(once, new)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_upsert_last_arrival_wins_among_new_rows(spark):
    old = raw(spark, [("2026-01-05", "AAA", 1.0)])
    new = raw(spark, [("2026-01-05", "AAA", 9.0)]).withColumn("seq", F.lit(1)).unionByName(
        raw(spark, [("2026-01-05", "AAA", 5.0)]).withColumn("seq", F.lit(2))
    )
    with_seq = old.withColumn("seq", F.lit(0))
    merged = ingest.upsert_keep_last(with_seq, new, arrival=["seq"]).collect()
    assert [(r.close, r.seq) for r in merged] == [(5.0, 2)]


@pytest.mark.parametrize(
    ("last", "strategy", "start", "end"),
    [
        (None, "full", date(2021, 1, 12), date(2026, 1, 10)),
        (date(2026, 1, 10), "intraday", None, None),
        (date(2026, 1, 6), "gap", date(2026, 1, 7), date(2026, 1, 10)),
        (date(2026, 1, 11), "intraday", None, None),
        (date(2026, 1, 12), "intraday", None, None),
    ],
)
def test_fetch_plan(spark, last, strategy, start, end):
    bars = spark.createDataFrame(
        [("AAA", last)] if last else [], "ticker string, trade_date date"
    )
    universe = spark.createDataFrame([("AAA",)], "ticker string")
    for plan in (
        ingest.fetch_plan(bars, universe, "2026-01-11"),
        ingest.fetch_plan_all(bars, "2026-01-11"),
    ):
        got = plan.first()
        assert (got.strategy, got.history_start, got.history_end) == (strategy, start, end)
        assert got.fetch_intraday and got.fetch_history == (strategy != "intraday")


def state(spark, latest):
    rows = [(latest, "x")] if latest else []
    return spark.createDataFrame(rows, "latest_date string, last_processed_at string")


@pytest.mark.parametrize(
    ("cached", "check", "force", "news", "run"),
    [
        (None, True, False, True, True),
        ("2026-01-05", True, False, True, True),
        ("2026-01-05(1)", True, False, False, False),
        ("2026-01-05(1)", True, True, False, True),
        ("2026-01-05(1)", False, False, False, True),
    ],
)
def test_freshness_gate(spark, cached, check, force, news, run):
    data = raw(spark, [("2026-01-05", "AAA", 1.0), ("2026-01-05(1)", "AAA", 1.0)])
    got = ingest.freshness_gate(data, state(spark, cached), "2026-01-07", check, force).first()
    assert (got.has_new_data, got.should_run, got.days_old) == (news, run, 2)
    assert (got.latest_date, got.total_rows) == ("2026-01-05(1)", 2)


def test_freshness_gate_without_rows(spark):
    got = ingest.freshness_gate(raw(spark, []), state(spark, None), "2026-01-07").first()
    assert not got.success


def test_universe_joins(spark, make_bars):
    bars = make_bars([("AAA", 0, 0, 1, 1, 1, 1, 1), ("BBB", 0, 0, 1, 1, 1, 1, 1)])
    universe = spark.createDataFrame([("AAA",), ("ZZZ",)], "ticker string")
    assert [r.ticker for r in ingest.universe_filter(bars, universe).collect()] == ["AAA"]
    assert [r.ticker for r in ingest.universe_missing(universe, bars).collect()] == ["ZZZ"]


def test_summary_counts(spark):
    old = raw(spark, [("2026-01-05", "AAA", 1.0), ("2026-01-06", "AAA", 2.0)])
    history = raw(spark, [("2026-01-06", "AAA", 3.0), ("2026-01-07", "AAA", 4.0)])
    intraday = raw(spark, [("2026-01-07(1)", "AAA", 4.0)])
    got = ingest.ingest_summary(old, history, intraday).first().asDict()
    assert got == {
        "history_rows": 2,
        "intraday_rows": 1,
        "new_rows": 3,
        "existing_rows": 2,
        "merged_rows": 5,
        "deduped_rows": 4,
    }


def test_recent_days(make_bars):
    bars = make_bars([("AAA", day, 0, 1, 1, 1, 1, 1) for day in range(10)])
    assert ingest.recent_days(bars, 3).count() == 4


@pytest.mark.parametrize(
    ("as_of", "expected"),
    [
        ("2026-01-08", "2026-01-09"),
        ("2026-01-09", "2026-01-12"),
        ("2026-01-10", "2026-01-12"),
        ("2026-01-11", "2026-01-12"),
    ],
)
def test_calendar_skips_weekends(spark, as_of, expected):
    day = F.lit(as_of).cast("date")
    got = spark.range(1).select(
        dates.next_trading_day(day).cast("string").alias("next"),
        dates.trading_days(day, 15).alias("days"),
    ).first()
    assert got.next == expected
    assert len(got.days) == 15 and all(d.weekday() < 5 for d in got.days)
    assert got.days == sorted(set(got.days))
