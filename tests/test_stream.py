from datetime import datetime

from tidemark.operators import ingest
from tidemark.sources import months, sample
from tidemark.streaming import session_bars as stream

SMALL = "/root/testdata/sf0.001"


def events(spark, rows):
    full = [(i, datetime.fromisoformat(ts), 1, price) for i, (ts, price) in enumerate(rows)]
    return spark.createDataFrame(full, stream.EVENTS).coalesce(1)


def run(spark, folder, target, checkpoint):
    bars = stream.session_bars(stream.read_ticks(spark, folder, "*.parquet"))
    stream.run_available(bars, target, checkpoint)
    return stream.stored_bars(spark, target)


def test_stream_equals_batch(spark, path):
    bars = stream.session_bars(stream.read_ticks(spark, SMALL))
    target = path("stream")
    stream.run_available(bars, target, path("state"))
    got = stream.stored_bars(spark, target)
    batch = ingest.session_bars(sample.ticks(spark, SMALL))
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()


def test_restart_continues_and_late_ticks_are_dropped(spark, path):
    folder, target, checkpoint = path("ticks"), path("bars"), path("state")
    events(spark, [("2026-01-05 09:30:00", 1.0), ("2026-01-05 10:00:00", 3.0)]).write.parquet(folder)
    # Today's bar is there before the day is over.
    assert [r.close for r in run(spark, folder, target, checkpoint).collect()] == [3.0]
    events(spark, [("2026-01-05 11:00:00", 2.0), ("2026-01-06 14:00:00", 5.0)]).write.mode("append").parquet(folder)
    first = run(spark, folder, target, checkpoint).filter("session = 1").collect()
    assert [(r.session, r.open, r.high, r.close, r.volume) for r in first] == [(1, 1.0, 3.0, 2.0, 3)]
    # A day later, a tick for the closed day comes too late; the open day closes.
    events(spark, [("2026-01-05 11:10:00", 99.0), ("2026-01-07 14:00:00", 6.0)]).write.mode("append").parquet(folder)
    events(spark, [("2026-01-08 14:00:00", 6.0)]).write.mode("append").parquet(folder)
    rows = run(spark, folder, target, checkpoint).orderBy("trade_date").collect()
    assert [str(r.trade_date) for r in rows][:2] == ["2026-01-05", "2026-01-06"]
    assert max(r.high for r in rows) < 99.0
    assert len({(r.trade_date, r.session) for r in rows}) == len(rows)


def bars_of(spark, rows):
    day = datetime.fromisoformat("2026-01-05").date()
    full = [(t, day.replace(month=m), 1, c, c, c, c, 1) for t, m, c in rows]
    return spark.createDataFrame(full, stream.BARS)


def held(spark, target):
    return {(r.ticker, r.trade_date.month): r.close for r in stream.stored_bars(spark, target).collect()}


def test_replayed_batches_change_nothing(spark, path):
    target = path("bars")
    stream.upsert(bars_of(spark, [("A", 1, 1.0), ("B", 2, 2.0)]), 0, target)
    stream.upsert(bars_of(spark, [("A", 1, 3.0)]), 1, target)
    state = {r.month: r.files for r in months._files(spark, f"{target}/bars").collect()}
    for number, close in ((1, 3.0), (0, 1.0)):
        stream.upsert(bars_of(spark, [("A", 1, close)]), number, target)
    assert {r.month: r.files for r in months._files(spark, f"{target}/bars").collect()} == state
    assert held(spark, target) == {("A", 1): 3.0, ("B", 2): 2.0}


def test_a_batch_cut_off_before_the_ledger_runs_again(spark, path):
    """The bars are there, the ledger is not: the same and later numbers still end right."""
    target = path("bars")
    stream.upsert(bars_of(spark, [("A", 1, 1.0)]), 4, target)
    spark.range(1).selectExpr("3L AS batch").write.mode("overwrite").parquet(f"{target}/ledger")
    stream.upsert(bars_of(spark, [("A", 1, 1.0)]), 4, target)
    assert held(spark, target) == {("A", 1): 1.0} and stream.last_batch(spark, target) == 4


def test_files_are_bounded_by_months(spark, path):
    target = path("bars")
    for number in range(6):
        stream.upsert(bars_of(spark, [("A", 1, float(number)), ("B", 2, 0.0)]), number, target)
    stream.upsert(bars_of(spark, []), 6, target)
    files = {r.month: int(r.files.split("-")[0]) for r in months._files(spark, f"{target}/bars").collect()}
    assert set(files) == {"2026-01", "2026-02"} and max(files.values()) == 1
    assert held(spark, target) == {("A", 1): 5.0, ("B", 2): 0.0}
