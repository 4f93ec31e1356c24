"""Monthly folders: facts, newest rows, and feature months refreshed by themselves."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import features, ingest, models, scale
from tidemark.plans import jobs
from tidemark.sources import files, months, sample

SMALL = "/root/testdata/sf0.001"


def raw(spark, rows):
    full = [(d, t, c, c, c, c, 1.0) for d, t, c in rows]
    return spark.createDataFrame(full, schemas.RAW_BARS)


def months_of(spark, where):
    """State of the files of each month."""
    return {r.month: r.files for r in months._files(spark, where).collect()}


def test_facts_count_changed_months_only(spark, path):
    target = path("raw")
    files.merge_raw(spark, target, raw(spark, [("2026-01-05", "A", 1.0), ("2026-02-02(1)", "A", 2.0), ("n/a", "B", 3.0)]))
    before = months_of(spark, months.facts_path(target))
    files.merge_raw(spark, target, raw(spark, [("2026-02-02(1)", "A", 4.0), ("2026-02-02(2)", "C", 5.0)]))
    after = months_of(spark, months.facts_path(target))
    assert {m for m in after if before.get(m) != after[m]} == {"2026-02"}
    known = {(r.month, r.ticker): (r["rows"], r["keys"], r.newest_key) for r in files.raw_facts(spark, target).collect()}
    assert known == {
        ("2026-01", "A"): (1, 1, "2026-01-05"),
        ("2026-02", "A"): (1, 1, "2026-02-02(1)"),
        ("2026-02", "C"): (1, 1, "2026-02-02(2)"),
        ("unreadable", "B"): (1, 1, None),
    }


def test_facts_notice_other_writers(spark, path):
    """Months written or dropped by someone else are counted anew or forgotten."""
    target = path("raw")
    files.merge_raw(spark, target, raw(spark, [("2026-01-05", "A", 1.0), ("2026-02-02", "B", 2.0)]))
    raw(spark, [("2026-03-03", "A", 1.0)]).withColumn("month", F.lit("2026-03")).write.mode("append").partitionBy("month").parquet(target)
    assert {(r.month, r.ticker) for r in files.raw_facts(spark, target).collect()} == {
        ("2026-01", "A"), ("2026-02", "B"), ("2026-03", "A")
    }
    assert str(files.raw_state(spark, target).first().last_date) == "2026-03-03"


def test_facts_of_nothing_and_without_folders(spark, path):
    assert files.raw_facts(spark, path("missing")).isEmpty()
    plain = path("plain")
    raw(spark, [("2026-01-05", "A", 1.0), ("2026-02-02", "A", 2.0)]).write.parquet(plain)
    row = files.raw_facts(spark, plain).first()
    assert (row.month, row["rows"], row.newest_key) == ("", 2, "2026-02-02")
    assert months.ending_rows(spark, plain, schemas.RAW_BARS).count() == 2


def test_newest_rows_read_the_months_in_which_tickers_end(spark, path):
    target = path("raw")
    rows = [(f"2026-{m:02d}-0{d}", "A", float(m)) for m in range(1, 7) for d in (1, 2)]
    files.merge_raw(spark, target, raw(spark, [*rows, ("2026-02-07", "OLD", 9.0), ("n/a", "LOST", 1.0)]))
    ends = months.ending_rows(spark, target, schemas.RAW_BARS)
    text = ends._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month#" in text and "IN (2026-02,2026-06,unreadable)" in text
    assert {(r.ticker, r.date) for r in ends.collect()} == {
        ("A", "2026-06-01"), ("A", "2026-06-02"), ("OLD", "2026-02-07"), ("LOST", "n/a")
    }


def feature_map(spark, paths, names=("target", "close", *schemas.SCALED)):
    rows = files.scan_features(spark, paths.features).collect()
    return {(r.ticker, r.date): tuple(r[n] for n in names) for r in rows}


@pytest.mark.parametrize("collapse", [False, True])
def test_recent_months_equal_a_full_run(spark, path, collapse):
    """Sparse and dirty bars, tickers that pause, start or stop: 30 days refreshed as if run whole."""
    draw = random.Random(7)
    rows = []
    for ticker, step in (("DAILY", 1), ("SPARSE", 17), ("PAUSED", 3), ("STALE", 2), ("NEW", 2), ("DIRTY", 2)):
        for at in range(0, 400, step):
            day = date(2025, 1, 1) + timedelta(days=at)
            if (ticker == "PAUSED" and 200 < at < 390) or (ticker == "STALE" and at > 150) or (ticker == "NEW" and at < 360):
                continue
            volume = None if ticker == "DIRTY" and at > 100 and at % 20 else 100.0 + draw.random()
            mark = draw.choice(["", "(1)", "(2)"]) if ticker in ("DAILY", "DIRTY") else ""
            price = 10 + draw.random()
            rows.append((f"{day}{mark}", ticker, price, price + 1, price - 1, price + draw.random(), volume))
    data = spark.createDataFrame(rows, schemas.RAW_BARS)
    late = F.col("date") >= "2026-01-20"
    target = path("raw")
    paths = jobs.Paths.under(path("step"), target)
    files.merge_raw(spark, target, data.filter(~late))
    jobs.preprocess(spark, paths, collapse=collapse)
    before = feature_map(spark, paths)
    state = months_of(spark, paths.features)
    files.merge_raw(spark, target, data.filter(late))
    jobs.preprocess(spark, paths, recent_days=30, collapse=collapse)
    whole = jobs.Paths.under(path("whole"), target)
    jobs.preprocess(spark, whole, collapse=collapse)
    got, expected = feature_map(spark, paths), feature_map(spark, whole)
    assert got.keys() == expected.keys()
    for key, values in got.items():
        if key[1] >= "2026-01":
            assert values == pytest.approx(expected[key], abs=1e-9, nan_ok=True)
        else:
            # Older rows keep their scaled values; labels that are known now are filled in.
            assert values[0] == expected[key][0] and values[1:] == before[key][1:]
    # PAUSED had its last label in July; nothing else that is old was written.
    changed = {m for m, s in months_of(spark, paths.features).items() if state.get(m) != s}
    assert {m for m in changed if m < "2026-01"} <= {"2025-07", "2025-12"} and "2025-07" in changed
    assert spark.read.parquet(paths.info).count() == 6


def test_older_months_that_changed_are_refreshed_too(spark, path):
    """Bars that come late for an old month reach back further than the days asked for."""
    rows = [(f"2025-{m:02d}-{d:02d}", "A", 10.0 + (m * d) % 7) for m in range(1, 13) for d in (3, 9, 15, 21)]
    target = path("raw")
    paths, whole = jobs.Paths.under(path("step"), target), jobs.Paths.under(path("whole"), target)
    files.merge_raw(spark, target, raw(spark, [r for r in rows if r[0] != "2025-09-15"]))
    jobs.preprocess(spark, paths)
    before = months_of(spark, paths.features)
    files.merge_raw(spark, target, raw(spark, rows))
    # The same bars again: files are new, so these months count as changed.
    jobs.preprocess(spark, paths, recent_days=1)
    jobs.preprocess(spark, whole)
    names = ("target", "close")
    assert feature_map(spark, paths, names) == feature_map(spark, whole, names)
    files.merge_raw(spark, target, raw(spark, [("2025-11-27", "A", 3.0)]))
    state = months_of(spark, paths.features)
    jobs.preprocess(spark, paths, recent_days=1)
    jobs.preprocess(spark, whole)
    assert feature_map(spark, paths, names) == feature_map(spark, whole, names)
    assert {m for m, s in months_of(spark, paths.features).items() if state[m] != s} == {"2025-11", "2025-12"}
    assert before.keys() == state.keys()


def test_recent_days_of_the_sample(spark, path):
    """Monthly bars: thirty days hold fewer bars than a window, and lose no row."""
    target = path("raw")
    files.save_raw(ingest.to_raw(sample.bars(spark, SMALL)), target)
    paths = jobs.Paths.under(path("job"), target)
    rows = jobs.preprocess(spark, paths, recent_days=30)["rows"]
    before = feature_map(spark, paths)
    assert jobs.preprocess(spark, paths, recent_days=30)["rows"] == rows > 0
    after = feature_map(spark, paths)
    assert after.keys() == before.keys()
    assert all(after[k] == pytest.approx(before[k], abs=1e-12) for k in after)


def test_moments_of_months_give_the_scaler(spark, make_bars):
    bars = make_bars([("AAA", i, 0, *(1e6 + (i * 37) % 11 + k for k in range(4)), 5.0 + i % 3) for i in range(120)])
    rows = features.feature_rows(bars)
    month = F.substring(F.col("trade_date").cast("string"), 1, 7)
    merged = {r.feature: (r["mean"], r["std"]) for r in scale.merge_moments(scale.month_moments(rows, month)).collect()}
    once = {r.feature: (r["mean"], r["std"]) for r in scale.scaler_stats(rows).collect()}
    for name, (mean, std) in once.items():
        assert merged[name] == pytest.approx((mean, std), rel=1e-9, abs=1e-15)


def test_facts_are_counted_without_a_sort(spark, path):
    """The newest key is a number while it is looked for; merged months need no grouping by key."""
    target = path("raw")
    files.merge_raw(spark, target, raw(spark, [("2026-01-05(2)", "A", 1.0), ("1969-12-31(1)", "B", 1.0), ("x", "B", 1.0)]))
    rows = months.scan(spark, target, schemas.RAW_BARS)
    for once in (False, True):
        counted = months._counted(rows, once)
        text = counted._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in text
        assert text.count("Exchange") == (1 if once else 2)
        assert {(r.ticker, r.month): (r.newest_key, str(r.newest_date)) for r in counted.collect()} == {
            ("A", "2026-01"): ("2026-01-05(2)", "2026-01-05"),
            ("B", "1969-12"): ("1969-12-31(1)", "1969-12-31"),
            ("B", "unreadable"): (None, "None"),
        }


def test_merge_takes_only_its_own_months_for_free_of_repeats(spark, path):
    target = path("raw")
    files.save_raw(raw(spark, [("2026-01-05", "A", 1.0), ("2026-01-05", "A", 2.0), ("2026-02-02", "A", 1.0)]), target)
    files.merge_raw(spark, target, raw(spark, [("2026-02-02", "A", 3.0), ("2026-02-03", "A", 3.0)]))
    known = {r.month: (r["rows"], r["keys"]) for r in files.raw_facts(spark, target).collect()}
    assert known == {"2026-01": (2, 1), "2026-02": (2, 2)}


def test_ingest_reads_the_vendor_once(spark, path, make_bars, monkeypatch):
    """Counts and merge read what was taken from the vendor, not the vendor's table again."""
    daily = make_bars([(ticker, day, 0, 1, 2, 1, 2, 5) for ticker in "AB" for day in range(40)])
    paths = jobs.Paths.under(path("ingest"), path("ingest_raw"))
    files.save_raw(ingest.to_raw(daily.filter("trade_date < '2026-01-20'")), paths.raw)
    vendor = daily.groupBy("ticker", F.col("trade_date").alias("time")).agg(
        *(F.max(name).alias(name) for name in ("open", "high", "low", "close", "volume"))
    )
    ticks = spark.createDataFrame([], "ticker string, ts timestamp_ntz, event_id long, price double, volume long")
    seen = []
    merge = files.merge_raw
    monkeypatch.setattr(files, "merge_raw", lambda s, p, new, arrival=(): (seen.append(new), merge(s, p, new, arrival)))
    got = jobs.ingest_job(spark, paths, "2026-02-10", spark.createDataFrame([("A",)], "ticker string"), vendor, ticks)
    text = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in text and "Join" not in text
    # Days 15 (January 20) to 35 (February 9) of A.
    assert got["summary"].first().asDict() == {
        "history_rows": 21, "intraday_rows": 0, "new_rows": 21, "existing_rows": 30, "merged_rows": 51, "deduped_rows": 51,
    }


def test_gated_job_groups_feature_rows_by_no_key(spark, path, monkeypatch):
    """A table that was written whole has one row a key, so only its tickers are counted."""
    paths = jobs.Paths.under(path("gated"), path("gated_raw"))
    files.save_raw(ingest.to_raw(sample.bars(spark, SMALL)), paths.raw)
    counted, seen = months._counted, []
    monkeypatch.setattr(months, "_counted", lambda rows, once=False: (seen.append(once), counted(rows, once))[1])
    done = jobs.gated_job(spark, paths, "2024-01-31", lambda rows: models.fit_logistic(rows, 5), "logistic")
    assert done["forecast"] == "published" and seen == [False, True]
    again = counted(months.scan(spark, paths.features, schemas.FEATURE_TABLE))
    known = months.facts(spark, paths.features, schemas.FEATURE_TABLE).select(*again.columns)
    assert sorted(map(str, again.collect())) == sorted(map(str, known.collect()))
