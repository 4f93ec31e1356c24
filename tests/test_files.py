from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import ingest, models
from tidemark.plans import jobs, published
from tidemark.sources import files, sample

SMALL = "/root/testdata/sf0.001"


def raw(spark, rows):
    full = [(d, t, c, c, c, c, 1.0) for d, t, c in rows]
    return spark.createDataFrame(full, schemas.RAW_BARS)


def test_drift_union_skips_unreadable_files(spark, path):
    text, stamped, broken = path("text"), path("stamped"), path("broken")
    spark.createDataFrame([("2026-01-05(1)", "A", 1)], "date string, ticker string, n int").write.parquet(text)
    spark.createDataFrame(
        [(datetime(2026, 1, 6), "B", 2.5, "x")], "date timestamp_ntz, ticker string, n double, extra string"
    ).write.parquet(stamped)
    spark.createDataFrame([("not parquet",)], "value string").write.text(broken)
    got = files.scan_drift_union(spark, [text, broken, stamped]).orderBy("ticker")
    assert [tuple(r) for r in got.collect()] == [
        ("2026-01-05(1)", "A", 1.0, None),
        ("2026-01-06 00:00:00", "B", 2.5, "x"),
    ]
    with pytest.raises(FileNotFoundError):
        files.scan_drift_union(spark, [broken])


def test_merge_rewrites_only_touched_months(spark, path):
    target = path("raw")
    files.save_raw(raw(spark, [("2026-01-05", "A", 1.0), ("2026-02-05", "A", 2.0)]), target)
    january = f"{target}/month=2026-01"
    before = files.table_version(spark, january)
    files.merge_raw(spark, target, raw(spark, [("2026-02-05", "A", 9.0), ("2026-03-01", "B", 3.0)]))
    assert files.table_version(spark, january) == before
    got = {(r.date, r.ticker, r.close) for r in files.scan_raw(spark, target).collect()}
    assert got == {("2026-01-05", "A", 1.0), ("2026-02-05", "A", 9.0), ("2026-03-01", "B", 3.0)}


def test_predictions_replace_only_their_dates(spark, path):
    target = path("preds")
    history = published.read(spark, SMALL, "history")
    files.save_predictions(history, target)
    one = history.filter("predicted_for_date = (select max(d) from values (date'2001-09-03') t(d))")
    changed = one.withColumn("probability", F.lit(0.0))
    files.save_predictions(changed, target)
    back = files.scan_predictions(spark, target)
    assert back.count() == history.count()
    assert back.filter("probability = 0.0").count() == one.count() > 0


def test_csv_round_trip(spark, path):
    target = path("csv")
    data = spark.createDataFrame([("FPT", 1.5, 2.0)], schemas.PRICE_VOLUME_CSV)
    files.export_csv(data, target)
    assert files.scan_price_volume_csv(spark, target).collect() == data.collect()
    signals = spark.createDataFrame([("FPT", "UP", 0.65)], schemas.SIGNAL_CSV)
    other = path("csv")
    files.export_csv(signals, other)
    assert files.scan_signal_csv(spark, other).collect() == signals.collect()


def test_indented_metrics_document(spark, path):
    text = """{
  "metrics": {"accuracy": 0.5, "f1_score": 0.25, "auc_roc": 0.625},
  "model_info": {"run_id": "r1", "experiment_id": "e", "params": {"max_depth": 5}},
  "saved_at": "2026-06-02T16:44:42.519965"
}"""
    target = path("metrics")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(target)
    got = files.scan_metrics(spark, target, multi_line=True).first()
    assert (got.run_id, got.auc, str(got.saved_at)) == ("r1", 0.625, "2026-06-02 16:44:42.519965")


def test_snapshot_copies_on_change_only(spark, path):
    source, target, state = path("source"), path("copy"), path("state")
    spark.range(3).write.parquet(source)
    act = lambda: files.snapshot_sync(spark, source, target, state).first().action
    assert [act(), act()] == ["copied", "up_to_date"]
    spark.range(5).write.mode("overwrite").parquet(source)
    assert act() == "copied" and spark.read.parquet(target).count() == 5
    spark.range(0).write.mode("overwrite").parquet(source)
    assert act() == "empty_source" and spark.read.parquet(target).count() == 5


def test_snapshot_of_nothing_copies_nothing(spark, path):
    empty = path("empty")
    spark.createDataFrame([("x",)], "value string").write.text(empty)
    for source in (path("missing"), empty):
        got = files.snapshot_sync(spark, source, path("copy"), path("state")).first()
        assert got.action == "empty_source"


def test_saved_table(spark, path):
    files.save_table(spark.range(2), "tidemark_test_table", path("table"))
    files.save_table(spark.range(4), "tidemark_test_table", path("table"))
    assert spark.table("tidemark_test_table").count() == 4


def test_preprocess_options(spark, path):
    where = path("raw")
    sample.raw_messy(spark, SMALL).write.parquet(where)
    plain, other = jobs.Paths.under(path("job"), where), jobs.Paths.under(path("job"), where)
    rows = jobs.preprocess(spark, plain)["rows"]
    assert rows == files.scan_features(spark, plain.features).count() > 0
    fewer = jobs.preprocess(spark, other, recent_days=900, collapse=True, train_share=0.8)["rows"]
    assert 0 < fewer < rows
    assert spark.read.parquet(other.scaler).count() == len(schemas.FEATURES)
    table = files.scan_features(spark, other.features)
    assert table.filter(F.col("date").contains("(")).isEmpty()
    assert spark.read.parquet(plain.info).count() == 10


def test_gated_job_runs_once_then_skips(spark, path):
    where = path("raw")
    bars = ingest.to_raw(sample.bars(spark, SMALL))
    bars.write.parquet(where)
    paths = jobs.Paths.under(path("gated"), where)
    fit = lambda rows: models.fit_logistic(rows, 20)
    first = jobs.gated_job(spark, paths, "2024-01-31", fit, "logistic")
    assert first["status"] == "success" and first["forecast"] == "published"
    assert first["wide"].count() == 10
    assert first["report"]["feature_importance"].count() == 3
    assert jobs.gated_job(spark, paths, "2024-02-01", fit, "logistic")["status"] == "skipped"
    forced = jobs.gated_job(spark, paths, "2024-02-02", fit, "logistic", force=True)
    # The same data gives the same AUC, which is no strict gain: the champion stays.
    assert forced["champion"] == first["champion"] == first["run_id"] != forced["run_id"]
    assert [g.promoted for g in forced["gate"].orderBy("run_no").collect()] == [True, False]


def test_repeated_day_keeps_the_better_champion(spark, path):
    """A worse second run of one day changes neither champion nor forecast."""
    table = path("features")
    files.save_features(published.read(spark, SMALL, "features"), table)
    paths = jobs.Paths.under(path("daily"), published.path(spark, SMALL, "raw"), features=table)
    better = lambda rows: models.fit_logistic(rows, 50)
    worse = lambda rows: models.fit_logistic(rows.withColumn("target", 1 - F.col("target")), 50)
    first = jobs.daily_job(spark, paths, "2024-01-31", better, "logistic")
    wide = sorted(map(str, first["wide"].collect()))
    second = jobs.daily_job(spark, paths, "2024-01-31", worse, "logistic")
    assert second["champion"] == first["champion"] == first["run_id"]
    assert sorted(map(str, second["wide"].collect())) == wide
    rows = {r.run_id: r for r in second["runs"].collect()}
    assert rows[second["run_id"]].auc < rows[first["run_id"]].auc
    assert all(r.train_seconds > 0 and "maxIter" in r.params for r in rows.values())


def test_first_merge_creates_and_unreadable_dates_stay(spark, path):
    target = path("raw")
    assert not files.raw_state(spark, target).first()["exists"]
    files.merge_raw(spark, target, raw(spark, [(None, "A", 1.0), ("2026-01-05", "A", 2.0)]))
    files.merge_raw(spark, target, raw(spark, [("n/a", "B", 3.0), (None, "B", 4.0)]))
    got = {(r.date, r.ticker) for r in files.scan_raw(spark, target).collect()}
    assert got == {(None, "A"), ("2026-01-05", "A"), ("n/a", "B"), (None, "B")}
    state = files.raw_state(spark, target).first()
    assert state["exists"] and state["has_rows"] and str(state["last_date"]) == "2026-01-05"


def test_last_arrival_stays(spark, path):
    target = path("raw")
    rows = raw(spark, [("2026-01-05", "A", 9.0)]).withColumn("arrived", F.lit(1)).union(
        raw(spark, [("2026-01-05", "A", 2.0)]).withColumn("arrived", F.lit(2))
    )
    files.merge_raw(spark, target, rows, arrival=("arrived",))
    assert files.scan_raw(spark, target).first().close == 2.0
    files.merge_raw(spark, target, raw(spark, [("2026-01-05", "A", 1.0)]))
    assert files.scan_raw(spark, target).first().close == 1.0


def test_drift_union_says_what_it_leaves_out(spark, path):
    good, text = path("good"), path("text")
    spark.range(2).write.parquet(good)
    spark.createDataFrame([("x",)], "value string").write.text(text)
    skipped = []
    assert files.scan_drift_union(spark, [good, text, good], skipped).count() == 4
    assert skipped == [text]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.scan_drift_union(spark, [good, path("missing")])


def test_recent_days_prune_months(spark, path):
    target = path("raw")
    files.save_raw(ingest.to_raw(sample.bars(spark, SMALL, "day")), target)
    recent = files.recent_raw(spark, target, 40)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    months = {r.m for r in recent.select(F.substring("date", 1, 7).alias("m")).distinct().collect()}
    assert len(months) in (2, 3)


def test_mirror_copies_changed_folders_only(spark, path):
    source, target = path("source"), path("mirror")
    assert files.mirror(spark, source, target) == {"copied": 0, "kept": 0, "dropped": 0}
    files.merge_raw(spark, source, raw(spark, [("2026-01-05", "A", 1.0), ("2026-02-02", "B", 2.0)]))
    assert files.mirror(spark, source, target) == {"copied": 2, "kept": 0, "dropped": 0}
    held = files.mirrored(spark, target, schemas.RAW_BARS)
    files.merge_raw(spark, source, raw(spark, [("2026-02-02", "B", 3.0)]))
    assert files.mirror(spark, source, target) == {"copied": 1, "kept": 1, "dropped": 0}
    assert files.mirror(spark, source, target) == {"copied": 0, "kept": 2, "dropped": 0}
    # A reader that began before the copy still reads the state it saw.
    assert {(r.ticker, r.close) for r in held.collect()} == {("A", 1.0), ("B", 2.0)}
    assert {(r.ticker, r.close) for r in files.mirrored(spark, target, schemas.RAW_BARS).collect()} == {("A", 1.0), ("B", 3.0)}


def test_mirror_drops_folders_and_survives_an_empty_source(spark, path):
    source, target = path("source"), path("mirror")
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "n int, part string")
    schema = rows.schema
    rows.write.partitionBy("part").parquet(source)
    files.mirror(spark, source, target)
    rows.filter("n = 2").write.mode("overwrite").partitionBy("part").parquet(source)
    assert files.mirror(spark, source, target)["dropped"] == 1
    assert [tuple(r) for r in files.mirrored(spark, target, schema).collect()] == [(2, "y")]
    rows.limit(0).write.mode("overwrite").parquet(source)
    assert files.mirror(spark, source, target) == {"copied": 0, "kept": 1, "dropped": 0}
    plain, copy = path("plain"), path("copy")
    spark.range(3).write.parquet(plain)
    assert files.mirror(spark, plain, copy)["copied"] == 1
    assert files.mirrored(spark, copy, spark.range(1).schema).count() == 3
