"""Named queries: each runs one operator over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import dates, numbers, tiers
from tidemark.functions.numbers import to_digits
from tidemark.operators import (
    clean,
    features,
    forecast,
    ingest,
    latest,
    metrics,
    models,
    predictions,
    report,
    scale,
    segments,
    serving,
)
from tidemark.plans import jobs, published
from tidemark.plans.published import AS_OF, DIGITS
from tidemark.sources import files, months, sample, store
from tidemark.streaming import session_bars as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The day ingest decisions are taken on: within the last days of the trades.
INGEST_DAY = "2001-10-28"
# Bars before this day are stored already when the ingest job starts.
STORED_UNTIL = "2001-06-01"
# Bars from this day on come after the first run of the feature table, and the days refreshed then.
REFRESHED_FROM = "2001-09-20"
RECENT_DAYS = 30
# Ratios are compared to this many digits; sums may be added in another order.
RATIO_DIGITS = 9


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return add


def _rounded(df: DataFrame, *columns: str, digits: int = RATIO_DIGITS) -> DataFrame:
    return df.withColumns({name: to_digits(F.col(name), digits) for name in columns})


# Sources and sinks


@query("scan_raw")
def scan_raw(spark, sf_dir):
    return files.scan_raw(spark, published.path(spark, sf_dir, "raw"))


@query("scan_features")
def scan_features(spark, sf_dir):
    return files.scan_features(spark, published.path(spark, sf_dir, "features"))


@query("scan_drift_union")
def scan_drift_union(spark, sf_dir):
    """Three datasets: dates as text, dates as timestamps without volume, extra column."""
    raw = ingest.to_raw(sample.bars(spark, sf_dir))
    number = F.substring("ticker", 2, 20).cast("bigint") % 3
    old = (
        raw.filter(number == 1)
        .withColumn("date", F.to_timestamp("date").cast("timestamp_ntz"))
        .drop("volume")
    )
    wider = raw.filter(number == 2).withColumn("volume", F.col("volume").cast("bigint"))
    parts = (raw.filter(number == 0), old, wider.withColumn("source", F.lit("vendor")))
    paths = []
    for part in parts:
        target = store.new_path(spark, "drift")
        part.write.parquet(target)
        paths.append(target)
    return files.scan_drift_union(spark, paths)


@query("sink_features")
def sink_features(spark, sf_dir):
    target = store.new_path(spark, "sink_features")
    rows = features.feature_rows(sample.bars(spark, sf_dir))
    files.save_features(scale.feature_table(rows, digits=DIGITS), target)
    return files.scan_features(spark, target)


@query("sink_raw")
def sink_raw(spark, sf_dir):
    """Write the older bars, then merge the newer ones into the same dataset."""
    target = store.new_path(spark, "sink_raw")
    files.save_raw(ingest.to_raw(sample.bars(spark, sf_dir, status="O")), target)
    files.merge_raw(spark, target, ingest.to_raw(sample.bars(spark, sf_dir, status="F")))
    return files.scan_raw(spark, target)


@query("sink_table")
def sink_table(spark, sf_dir):
    name = "tidemark_price_volume"
    info = latest.stock_info(sample.bars(spark, sf_dir))
    files.save_table(info, name, store.new_path(spark, name))
    return spark.table(name)


@query("universe_filter")
def universe_filter(spark, sf_dir):
    return ingest.universe_filter(
        sample.bars(spark, sf_dir), sample.universe(spark, sf_dir)
    )


@query("universe_missing")
def universe_missing(spark, sf_dir):
    return ingest.universe_missing(
        sample.customers_as_universe(spark, sf_dir), sample.bars(spark, sf_dir)
    )


@query("sink_pred_by_date")
def sink_pred_by_date(spark, sf_dir):
    """Write every target date, then rewrite one of them."""
    target = store.new_path(spark, "sink_pred_by_date")
    preds = published.read(spark, sf_dir, "history")
    files.save_predictions(preds, target)
    files.save_predictions(predictions.latest(preds), target)
    return files.scan_predictions(spark, target)


@query("scan_pred_history")
def scan_pred_history(spark, sf_dir):
    return files.scan_predictions(spark, published.path(spark, sf_dir, "history"))


@query("csv_export")
def csv_export(spark, sf_dir):
    target = store.new_path(spark, "csv_export")
    view = forecast.csv_view(published.read(spark, sf_dir, "wide"))
    files.export_csv(view, target)
    return spark.read.csv(target, header=True, schema=view.schema)


@query("csv_scan")
def csv_scan(spark, sf_dir):
    target = store.new_path(spark, "csv_scan")
    info = published.read(spark, sf_dir, "info")
    files.export_csv(info.withColumnRenamed("close", "close_price"), target)
    return files.scan_price_volume_csv(spark, target)


@query("csv_scan_signals")
def csv_scan_signals(spark, sf_dir):
    target = store.new_path(spark, "csv_scan_signals")
    preds = predictions.latest(published.read(spark, sf_dir, "history"))
    files.export_csv(
        preds.select("ticker", "signal", F.col("probability").alias("confidence")), target
    )
    return files.scan_signal_csv(spark, target)


@query("metrics_io")
def metrics_io(spark, sf_dir):
    target = store.new_path(spark, "metrics_io")
    files.save_metrics(_model_runs(spark, sf_dir), target)
    return files.scan_metrics(spark, target).select(
        "run_id", "model", "accuracy", "f1", "auc", F.to_date("saved_at").alias("saved_at")
    )


@query("snapshot_sync")
def snapshot_sync(spark, sf_dir):
    """Copy once, find nothing to do the second time, serve the copy."""
    source = published.path(spark, sf_dir, "wide")
    target, state = store.new_path(spark, "snapshot"), store.new_path(spark, "state")
    first = files.snapshot_sync(spark, source, target, state).first()
    second = files.snapshot_sync(spark, source, target, state).first()
    if (first["action"], second["action"]) != ("copied", "up_to_date"):
        raise RuntimeError(f"unexpected sync: {first['action']}, {second['action']}")
    return spark.read.schema(schemas.forecast_wide()).parquet(target)


@query("mirror_sync")
def mirror_sync(spark, sf_dir):
    """Raw months served as a copy, some of them changed, and only those copied again."""
    source, target = store.new_path(spark, "mirrored_raw"), store.new_path(spark, "mirror")
    daily = ingest.to_raw(sample.bars(spark, sf_dir, "day"))
    late = F.col("date") >= STORED_UNTIL
    files.save_raw(daily.withColumn("volume", F.when(late, F.lit(0.0)).otherwise(F.col("volume"))), source)
    files.mirror(spark, source, target)
    files.merge_raw(spark, source, daily.filter(late))
    done = files.mirror(spark, source, target)
    if not 0 < done["copied"] < done["kept"]:
        raise RuntimeError(f"unexpected copy: {done}")
    return files.mirrored(spark, target, schemas.RAW_BARS)


# Ingestion


@query("normalize_history")
def normalize_history(spark, sf_dir):
    vendor = sample.bars(spark, sf_dir, "day").withColumnRenamed("trade_date", "time")
    return ingest.normalize_history(vendor)


@query("session_of_time")
def session_of_time(spark, sf_dir):
    """Markers by the local clock, and by the clock seven hours ahead."""
    here = ingest.with_session(sample.ticks(spark, sf_dir))
    ahead = dates.session_of(F.col("ts") + F.expr("INTERVAL 7 HOURS"))
    return here.select("event_id", "session", ahead.alias("session_from_utc"))


@query("session_filter")
def session_filter(spark, sf_dir):
    return ingest.session_ticks(sample.ticks(spark, sf_dir))


@query("session_bar")
def session_bar(spark, sf_dir):
    return _rounded(ingest.session_bars(sample.ticks(spark, sf_dir)))


@query("last_date")
def last_date(spark, sf_dir):
    return ingest.last_date(sample.raw_marked(spark, sf_dir))


@query("union_new")
def union_new(spark, sf_dir):
    history = ingest.to_raw(sample.bars(spark, sf_dir, "day"))
    intraday = ingest.to_raw(ingest.session_bars(sample.ticks(spark, sf_dir)))
    return ingest.union_new(
        history, intraday.withColumn("volume", F.col("volume").cast("double"))
    )


@query("upsert_keep_last")
def upsert_keep_last(spark, sf_dir):
    return ingest.upsert_keep_last(
        ingest.to_raw(sample.bars(spark, sf_dir, status="O")),
        ingest.to_raw(sample.bars(spark, sf_dir, status="F")),
    )


@query("sort_bars")
def sort_bars(spark, sf_dir):
    return ingest.sort_bars(sample.raw_marked(spark, sf_dir))


@query("fetch_plan")
def fetch_plan(spark, sf_dir):
    return ingest.fetch_plan(
        sample.bars(spark, sf_dir, "day"),
        sample.customers_as_universe(spark, sf_dir),
        INGEST_DAY,
    )


@query("fetch_plan_all")
def fetch_plan_all(spark, sf_dir):
    return ingest.fetch_plan_all(sample.bars(spark, sf_dir, "day"), AS_OF)


@query("recent_days")
def recent_days(spark, sf_dir):
    return ingest.recent_days(sample.bars(spark, sf_dir, "day"), 30)


@query("freshness_gate")
def freshness_gate(spark, sf_dir):
    """Messy raw rows; the state is what a run over the first part of the lines would have left."""
    seen = ingest.to_raw(sample.bars(spark, sf_dir, status="O")).agg(
        F.max("date").alias("latest_date"), F.max("date").alias("last_processed_at")
    )
    return ingest.freshness_gate(sample.raw_messy(spark, sf_dir), seen, AS_OF)


@query("ingest_summary")
def ingest_summary(spark, sf_dir):
    intraday = ingest.to_raw(ingest.session_bars(sample.ticks(spark, sf_dir)))
    return ingest.ingest_summary(
        ingest.to_raw(sample.bars(spark, sf_dir, status="O")),
        ingest.to_raw(sample.bars(spark, sf_dir, status="F")),
        intraday,
    )


# Cleaning


@query("canon_date")
def canon_date(spark, sf_dir):
    return clean.canonical_dates(sample.raw_messy(spark, sf_dir))


@query("quarantine")
def quarantine(spark, sf_dir):
    return clean.quarantine(sample.raw_messy(spark, sf_dir))


@query("strip_marker")
def strip_marker(spark, sf_dir):
    return clean.with_plain_date(sample.raw_messy(spark, sf_dir)).select(
        "ticker", "date", "trade_date"
    )


@query("drop_nulls")
def drop_nulls(spark, sf_dir):
    return clean.drop_nulls(clean.canonical_dates(sample.raw_messy(spark, sf_dir)))


@query("dedup_rows")
def dedup_rows(spark, sf_dir):
    """Whole rows; a third of them is there twice."""
    raw = sample.raw_messy(spark, sf_dir)
    again = raw.filter(F.substring("ticker", 2, 20).cast("bigint") % 3 == 0)
    return clean.dedup_rows(clean.canonical_dates(raw.unionByName(again)))


@query("dedup_keys")
def dedup_keys(spark, sf_dir):
    return clean.clean(sample.raw_messy(spark, sf_dir))


@query("collapse_sessions")
def collapse_sessions(spark, sf_dir):
    return clean.collapse_sessions(clean.clean(sample.raw_messy(spark, sf_dir)))


@query("profile")
def profile(spark, sf_dir):
    return clean.profile(sample.raw_messy(spark, sf_dir))


@query("sample_keys")
def sample_keys(spark, sf_dir):
    return clean.sample_keys(sample.raw_marked(spark, sf_dir))


# Features. The helper columns and each feature on monthly bars.

_FEATURE_QUERIES = {
    "f_lags": ("prev_close_1", "prev_close_3", "prev_close_5", "prev_close_10", "prev_volume_1"),
    "f_ma": ("ma5", "ma10"),
    "f_avg_vol20": ("avg_vol20",),
    "f_return_lags": ("return_lag1", "return_lag2", "return_lag3"),
    **{
        f"f_{name}": (name,)
        for name in schemas.FEATURES
        if not name.startswith("return_lag")
    },
}


def _feature_query(columns: tuple[str, ...]) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        full = features.with_features(sample.bars(spark, sf_dir))
        return _rounded(full.select("ticker", "trade_date", *columns), *columns)

    return build


for _name, _columns in _FEATURE_QUERIES.items():
    QUERIES[_name] = _feature_query(_columns)


@query("features_all")
def features_all(spark, sf_dir):
    rows = features.feature_rows(sample.bars(spark, sf_dir))
    return _rounded(rows.drop("session"), *schemas.FEATURES)


@query("features_split")
def features_split(spark, sf_dir):
    """The same rows from daily bars with every ticker cut into parts of 100 bars."""
    parts = segments.split(sample.bars(spark, sf_dir, "day"), part_rows=100)
    rows = features.feature_rows(parts)
    return _rounded(rows.drop("session"), *schemas.FEATURES)


# Labels and scaling


@query("target_label")
def target_label(spark, sf_dir):
    return features.with_target(sample.bars(spark, sf_dir, "day")).select(
        "ticker", "trade_date", "close", "target"
    )


@query("target_dist")
def target_dist(spark, sf_dir):
    labelled = features.with_target(sample.bars(spark, sf_dir, "day"))
    return _rounded(features.target_distribution(labelled), "percent")


@query("scaler_stats")
def scaler_stats(spark, sf_dir):
    rows = features.feature_rows(sample.bars(spark, sf_dir))
    return _rounded(scale.scaler_stats(rows), "mean", "std", digits=8)


@query("zscore")
def zscore(spark, sf_dir):
    rows = features.feature_rows(sample.bars(spark, sf_dir))
    return scale.zscore(rows, digits=DIGITS).select("ticker", "trade_date", *schemas.SCALED)


@query("zscore_train")
def zscore_train(spark, sf_dir):
    """Scaled with the statistics of the training fold only, stored and read back."""
    rows = features.feature_rows(sample.bars(spark, sf_dir))
    train = metrics.time_split(rows, F.col("trade_date")).filter("fold = 'train'")
    target = store.new_path(spark, "scaler")
    scale.scaler_stats(train).write.parquet(target)
    fitted = scale.scaler_row_of(
        spark.read.schema(schemas.SCALER).parquet(target)
    )
    scaled = scale.zscore(rows, fitted, DIGITS)
    return scaled.select("ticker", "trade_date", *schemas.SCALED)


@query("feature_table")
def feature_table(spark, sf_dir):
    rows = features.feature_rows(sample.bars(spark, sf_dir))
    return scale.feature_table(rows, digits=DIGITS)


@query("feature_table_daily")
def feature_table_daily(spark, sf_dir):
    rows = features.feature_rows(sample.bars(spark, sf_dir, "day"))
    return scale.feature_table(rows, digits=DIGITS)


@query("preprocess_job")
def preprocess_job(spark, sf_dir):
    """Messy rows written as a raw dataset, the whole job run on it, its table read."""
    raw = store.new_path(spark, "job_raw")
    sample.raw_messy(spark, sf_dir).write.parquet(raw)
    paths = jobs.Paths.under(store.new_path(spark, "job"), raw)
    jobs.preprocess(spark, paths, digits=DIGITS)
    return files.scan_features(spark, paths.features)


@query("preprocess_recent")
def preprocess_recent(spark, sf_dir):
    """New daily bars merged and the newest months refreshed; scaled values of refreshed rows only."""
    paths = jobs.Paths.under(store.new_path(spark, "recent"), store.new_path(spark, "recent_raw"))
    daily = sample.bars(spark, sf_dir, "day")
    late = F.col("trade_date") >= F.lit(REFRESHED_FROM).cast("date")
    files.save_raw(ingest.to_raw(daily.filter(~late)), paths.raw)
    jobs.preprocess(spark, paths, digits=DIGITS)
    files.merge_raw(spark, paths.raw, ingest.to_raw(daily.filter(late)))
    jobs.preprocess(spark, paths, recent_days=RECENT_DAYS, digits=DIGITS)
    table = files.scan_features(spark, paths.features)
    newest = sample.trades(spark, sf_dir).agg(F.max("trade_date")).scalar()
    first = F.trunc(F.least(F.date_sub(newest, RECENT_DAYS), F.lit(REFRESHED_FROM).cast("date")), "month")
    recent = dates.date_part_of(F.col("date")) >= first
    scaled = (F.when(recent, F.col(name)).alias(name) for name in schemas.SCALED)
    return table.select("date", "ticker", "target", *scaled, "close")


@query("month_facts")
def month_facts(spark, sf_dir):
    """What is kept of each month of a raw dataset after two merges."""
    raw = store.new_path(spark, "facts_raw")
    messy = sample.raw_messy(spark, sf_dir)
    late = dates.date_part_of(F.col("date")) >= F.lit(STORED_UNTIL).cast("date")
    late = F.coalesce(late, F.lit(False))
    files.merge_raw(spark, raw, messy.filter(~late))
    files.merge_raw(spark, raw, messy.filter(late))
    known = files.raw_facts(spark, raw)
    return known.select("month", "ticker", "rows", "keys", "newest_key", "newest_date")


@query("scaler_by_months")
def scaler_by_months(spark, sf_dir):
    """Means and deviations joined from the moments of each month."""
    rows = features.feature_rows(sample.bars(spark, sf_dir, "day"))
    month = F.substring(F.col("trade_date").cast("string"), 1, 7)
    return _rounded(scale.merge_moments(scale.month_moments(rows, month)), "mean", "std", digits=8)


# Newest rows


@query("latest_by_months")
def latest_by_months(spark, sf_dir):
    """Newest bars, from the months in which any ticker ends."""
    raw = store.new_path(spark, "ends_raw")
    files.save_raw(sample.raw_marked(spark, sf_dir), raw)
    return latest.latest_price_volume(months.ending_rows(spark, raw, schemas.RAW_BARS))


@query("latest_price_volume")
def latest_price_volume(spark, sf_dir):
    return latest.latest_price_volume(sample.raw_marked(spark, sf_dir))


@query("latest_features")
def latest_features(spark, sf_dir):
    return latest.latest_features(published.read(spark, sf_dir, "features"))


@query("latest_dates")
def latest_dates(spark, sf_dir):
    newest = latest.latest_features(published.read(spark, sf_dir, "features"))
    return latest.latest_dates(newest)


# Models


def _folds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return jobs.split_folds(published.read(spark, sf_dir, "features"))


def _test_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.score(sample.BLEND, _folds(spark, sf_dir)[1])


def _model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per fixed scorer and year of labelled rows."""
    scored = published.model_scores(spark, sf_dir).withColumn(
        "year", F.substring("date", 1, 4)
    )
    runs = metrics.evaluate(scored, ["model", "year"])
    return runs.select(
        F.concat_ws("-", "model", "year").alias("run_id"),
        "model",
        *(to_digits(F.col(name), RATIO_DIGITS).alias(name) for name in ("accuracy", "f1", "auc")),
        F.to_date(F.concat("year", F.lit("-12-31"))).alias("saved_at"),
    )


@query("time_split")
def time_split(spark, sf_dir):
    table = published.read(spark, sf_dir, "features")
    folds = metrics.time_split(table, dates.date_part_of(F.col("date")))
    return folds.select("ticker", "date", "target", "fold")


def _fitted_scores(spark: SparkSession, sf_dir: str, fit: jobs.Trainer) -> DataFrame:
    older, newer = _folds(spark, sf_dir)
    return models.score(fit(older), newer).select(
        "ticker", "date", "target", "probability", "prediction"
    )


_models: dict[tuple[str, str], str] = {}


def _gbt(spark: SparkSession, sf_dir: str):
    """The boosted model of the older rows, fitted and stored once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        store.ensure_checkpoint_dir(spark)
        target = store.new_path(spark, "gbt")
        models.save_model(models.fit_gbt(_folds(spark, sf_dir)[0]), target)
        _models[key] = target
    return models.load_model(_models[key])


@query("train_gbt")
def train_gbt(spark, sf_dir):
    return _fitted_scores(spark, sf_dir, lambda rows: _gbt(spark, sf_dir))


@query("train_lr")
def train_lr(spark, sf_dir):
    return _fitted_scores(spark, sf_dir, models.fit_logistic)


@query("train_rf")
def train_rf(spark, sf_dir):
    return _fitted_scores(spark, sf_dir, models.fit_forest)


def _checked(name: str, frame: DataFrame) -> DataFrame:
    """Rows, tickers and breaches of what holds for every scored table, whatever the model."""
    p, c = F.col("probability"), F.col
    apart = [F.coalesce(~p.between(0.0, 1.0), F.lit(True)).alias("bad_probability")]
    wrong = F.lit(False)
    if "signal" in frame.columns:
        wrong = c("signal") != F.when(c("prediction") == 1, "UP").otherwise("DOWN")
    elif "confidence" not in frame.columns:
        wrong = c("prediction") != F.when(p > 0.5, 1).otherwise(0)
    if "predicted_for_date" in frame.columns:
        wrong = wrong | (c("confidence") != tiers.confidence_tier(p))
    apart.append(F.coalesce(wrong | ~c("prediction").isin(0, 1), F.lit(True)).alias("bad_class"))
    return frame.agg(
        F.lit(name).alias("name"),
        F.count("*").alias("rows"),
        F.count_distinct("ticker").alias("tickers"),
        *(F.count(F.when(test, 1)).alias(test_name) for test, test_name in zip(apart, ("bad_probability", "bad_class"), strict=True)),
    )


@query("model_checks")
def model_checks(spark, sf_dir):
    """What must hold for the tables of fitted models, which SQL cannot compute."""
    names = ("train_gbt", "train_lr", "train_rf", "score_next_gbt", "forecast_15d_gbt", "forecast_15d_lr", "next_session_champion")
    checks = [_checked(name, QUERIES[name](spark, sf_dir)) for name in names]
    whole = checks[0]
    for other in checks[1:]:
        whole = whole.unionByName(other)
    return whole


@query("eval_accuracy")
def eval_accuracy(spark, sf_dir):
    return _rounded(metrics.accuracy(_test_scores(spark, sf_dir)), "accuracy")


@query("eval_f1")
def eval_f1(spark, sf_dir):
    return _rounded(metrics.f1(_test_scores(spark, sf_dir)), "f1")


@query("eval_auc")
def eval_auc(spark, sf_dir):
    return _rounded(metrics.auc(_test_scores(spark, sf_dir)), "auc")


@query("model_runs")
def model_runs(spark, sf_dir):
    return _model_runs(spark, sf_dir)


@query("champion_gate")
def champion_gate(spark, sf_dir):
    gate = metrics.champion_gate(_model_runs(spark, sf_dir))
    return _rounded(gate, "auc_change", "accuracy_change", "f1_change")


@query("model_leaderboard")
def model_leaderboard(spark, sf_dir):
    runs = metrics.evaluate(published.model_scores(spark, sf_dir), ["model"])
    return metrics.leaderboard(_rounded(runs, "accuracy", "f1", "auc"))


@query("confidence_tier")
def confidence_tier(spark, sf_dir):
    scored = models.score(sample.BLEND, published.read(spark, sf_dir, "features"))
    return scored.select(
        "ticker", "date", "probability", tiers.confidence_tier(F.col("probability")).alias("confidence")
    )


@query("trading_calendar")
def trading_calendar(spark, sf_dir):
    """The next trading days after every day on which anything was shipped."""
    days = sample.trades(spark, sf_dir).select(F.col("trade_date").alias("as_of")).distinct()
    listed = F.posexplode(dates.trading_days(F.col("as_of"), schemas.HORIZON))
    return days.select(
        "as_of", dates.next_trading_day(F.col("as_of")).alias("next_date"), listed.alias("pos", "date")
    ).select("as_of", "next_date", (F.col("pos") + 1).alias("day"), "date")


@query("score_next")
def score_next(spark, sf_dir):
    newest = latest.latest_features(published.read(spark, sf_dir, "features"))
    return models.score_next(sample.BLEND, newest, AS_OF)


@query("score_next_gbt")
def score_next_gbt(spark, sf_dir):
    newest = latest.latest_features(published.read(spark, sf_dir, "features"))
    return models.score_next(models.compiled(_gbt(spark, sf_dir)), newest, AS_OF)


@query("rollforward_step")
def rollforward_step(spark, sf_dir):
    newest = latest.latest_features(published.read(spark, sf_dir, "features"))
    stepped = forecast.rollforward_step(models.score(sample.BLEND, newest))
    return _rounded(stepped.select("ticker", "prediction", *schemas.SCALED), *schemas.SCALED)


@query("forecast_15d")
def forecast_15d(spark, sf_dir):
    return forecast.to_long(published.entries(spark, sf_dir))


@query("forecast_15d_floor")
def forecast_15d_floor(spark, sf_dir):
    """The HIGH threshold stops at 0.62, so that MEDIUM stays reachable."""
    newest = latest.latest_features(published.read(spark, sf_dir, "features"))
    return forecast.to_long(
        forecast.forecast(sample.BLEND, newest, AS_OF, tier_floor=0.62)
    )


@query("forecast_15d_gbt")
def forecast_15d_gbt(spark, sf_dir):
    newest = latest.latest_features(published.read(spark, sf_dir, "features"))
    packed = models.compiled(_gbt(spark, sf_dir))
    return forecast.to_long(forecast.forecast(packed, newest, AS_OF))


@query("forecast_15d_lr")
def forecast_15d_lr(spark, sf_dir):
    """A fitted logistic model, rolled forward as one column expression."""
    newest = latest.latest_features(published.read(spark, sf_dir, "features"))
    fitted = models.fit_logistic(_folds(spark, sf_dir)[0])
    return forecast.to_long(
        forecast.forecast(models.linear_scorer(fitted), newest, AS_OF)
    )


@query("forecast_wide")
def forecast_wide(spark, sf_dir):
    return forecast.pivot_wide(published.read(spark, sf_dir, "long"))


@query("forecast_csv_view")
def forecast_csv_view(spark, sf_dir):
    return forecast.csv_view(published.read(spark, sf_dir, "wide"))


@query("forecast_long")
def forecast_long(spark, sf_dir):
    return forecast.unpivot(published.read(spark, sf_dir, "wide"))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return models.feature_importance(spark, _gbt(spark, sf_dir))


@query("align_features")
def align_features(spark, sf_dir):
    """A table lacking two expected columns and carrying one too many."""
    table = published.read(spark, sf_dir, "features").drop(
        "volatility_5_scaled", "return_lag3_scaled"
    )
    extra = table.withColumn("unused", F.col("close"))
    return models.align_features(extra, schemas.SCALED, keep=("ticker", "date"))


@query("align_by_position")
def align_by_position(spark, sf_dir):
    bars = sample.bars(spark, sf_dir).select(*schemas.PRICES, "volume")
    return models.align_by_position(bars, 7)


@query("daily_job")
def daily_job(spark, sf_dir):
    """Train, record, forecast and publish; the published table is read back."""
    paths = jobs.Paths.under(
        store.new_path(spark, "daily"),
        published.path(spark, sf_dir, "raw"),
        features=published.path(spark, sf_dir, "features"),
    )
    store.ensure_checkpoint_dir(spark)
    return jobs.daily_job(spark, paths, AS_OF)["wide"]


@query("gated_job")
def gated_job(spark, sf_dir):
    """Run on messy new data, skip the second time; outcomes and what was made as rows."""
    store.ensure_checkpoint_dir(spark)
    raw = store.new_path(spark, "gated_raw")
    files.save_raw(sample.raw_messy(spark, sf_dir), raw)
    paths = jobs.Paths.under(store.new_path(spark, "gated"), raw)
    outcomes = [jobs.gated_job(spark, paths, AS_OF) for _ in range(2)]
    made = files.scan_features(spark, paths.features).count()
    forecasts = outcomes[0]["wide"].count()
    rows = [
        (i, o["status"], o["latest_date"], o["days_old"], o["has_new_data"], made, forecasts)
        for i, o in enumerate(outcomes, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "run int, status string, latest_date string, days_old int, has_new_data boolean,"
        " feature_rows long, forecast_rows long",
    )


@query("ingest_job")
def ingest_job(spark, sf_dir):
    """A stored dataset brought up to date from vendor bars and ticks, read back."""
    paths = jobs.Paths.under(store.new_path(spark, "ingest"), store.new_path(spark, "ingest_raw"))
    daily = sample.bars(spark, sf_dir, "day")
    old = daily.filter(F.col("trade_date") < F.lit(STORED_UNTIL).cast("date"))
    files.save_raw(ingest.to_raw(old), paths.raw)
    vendor = daily.withColumnRenamed("trade_date", "time")
    listed = sample.universe(spark, sf_dir)
    jobs.ingest_job(spark, paths, INGEST_DAY, listed, vendor, sample.ticks(spark, sf_dir))
    return files.scan_raw(spark, paths.raw)


@query("next_session_job")
def next_session_job(spark, sf_dir):
    """The newest bars scored and stored by target date, as the questions find them."""
    paths = jobs.Paths.under(
        store.new_path(spark, "next"), "", features=published.path(spark, sf_dir, "features")
    )
    return predictions.latest(jobs.next_session_job(spark, paths, AS_OF, sample.BLEND))


@query("next_session_champion")
def next_session_champion(spark, sf_dir):
    """The next session by the model that the gate names: the boosted one beats a coin."""
    paths = jobs.Paths.under(
        store.new_path(spark, "champion"), "", features=published.path(spark, sf_dir, "features")
    )
    older, newer = _folds(spark, sf_dir)
    for run_id, model in (("logistic", models.fit_logistic(older, 1)), ("gbt", _gbt(spark, sf_dir))):
        models.save_model(model, f"{paths.models}/{run_id}")
        scores = models.score(model, newer).select("target", "probability", "prediction")
        run = metrics.evaluate(store.staged(scores, "scores")).select(
            F.lit(run_id).alias("run_id"),
            F.lit(run_id).alias("model"),
            "*",
            F.lit(f"{AS_OF} 00:00:0{int(run_id == 'gbt')}").cast("timestamp_ntz").alias("saved_at"),
        )
        files.save_metrics(run, paths.runs)
    return predictions.latest(jobs.next_session_job(spark, paths, AS_OF))


@query("number_text")
def number_text(spark, sf_dir):
    """Closes and volumes as the dashboard shows them."""
    info = published.read(spark, sf_dir, "info")
    return info.select(
        "ticker", numbers.number_text(F.col("close")).alias("close"), numbers.number_text(F.col("volume") * 1000).alias("volume")
    )


# Predictions of the next session


def _preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions.latest(published.read(spark, sf_dir, "history"))


@query("pred_latest")
def pred_latest(spark, sf_dir):
    return _preds(spark, sf_dir)


@query("pred_for_ticker")
def pred_for_ticker(spark, sf_dir):
    return predictions.for_ticker(_preds(spark, sf_dir), "S5")


@query("pred_by_signal")
def pred_by_signal(spark, sf_dir):
    return predictions.by_signal(_preds(spark, sf_dir), 1)


@query("pred_high_conf")
def pred_high_conf(spark, sf_dir):
    return predictions.high_confidence(_preds(spark, sf_dir))


@query("pred_history")
def pred_history(spark, sf_dir):
    return predictions.history(published.read(spark, sf_dir, "history"), "2001-09-15", 365)


@query("pred_history_ticker")
def pred_history_ticker(spark, sf_dir):
    return predictions.history(
        published.read(spark, sf_dir, "history"), "2001-09-15", 365, "S7"
    )


@query("pred_summary")
def pred_summary(spark, sf_dir):
    return predictions.summary(_preds(spark, sf_dir))


@query("pred_top_up")
def pred_top_up(spark, sf_dir):
    return predictions.top_up(_preds(spark, sf_dir))


@query("pred_top_up_high")
def pred_top_up_high(spark, sf_dir):
    return predictions.top_up(_preds(spark, sf_dir), only_high=True)


@query("pred_top_down")
def pred_top_down(spark, sf_dir):
    return _rounded(predictions.top_down(_preds(spark, sf_dir)), "probability")


# Serving


def _info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published.read(spark, sf_dir, "info")


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published.read(spark, sf_dir, "wide")


@query("stock_list")
def stock_list(spark, sf_dir):
    return serving.stock_list(_info(spark, sf_dir))


@query("asof_latest_slice")
def asof_latest_slice(spark, sf_dir):
    return serving.as_of_global(_wide(spark, sf_dir)).select(
        "ticker", "latest_data_date", "day_1_prediction", "day_1_probability"
    )


@query("stock_search")
def stock_search(spark, sf_dir):
    return serving.stock_search(_info(spark, sf_dir), "s1")


@query("stock_sorted_page")
def stock_sorted_page(spark, sf_dir):
    return serving.stock_page(_info(spark, sf_dir), "price", "desc", 10, 20)


@query("stock_sorted_volume")
def stock_sorted_volume(spark, sf_dir):
    return serving.stock_page(_info(spark, sf_dir), "volume", "asc", 25)


@query("stock_count")
def stock_count(spark, sf_dir):
    return serving.stock_count(_info(spark, sf_dir))


@query("sync_status")
def sync_status(spark, sf_dir):
    return serving.sync_status(_wide(spark, sf_dir))


@query("recommendations")
def recommendations(spark, sf_dir):
    return serving.recommendations(_wide(spark, sf_dir))


@query("next_batch")
def next_batch(spark, sf_dir):
    return serving.next_batch(_wide(spark, sf_dir))


@query("next_batch_list")
def next_batch_list(spark, sf_dir):
    return serving.next_batch(_wide(spark, sf_dir), " s1, S2 ,s3,S5,s8,S13,S21,S34")


@query("next_batch_table")
def next_batch_table(spark, sf_dir):
    return serving.next_batch(_wide(spark, sf_dir), sample.universe(spark, sf_dir))


@query("top_buy")
def top_buy(spark, sf_dir):
    return serving.top_buy(_wide(spark, sf_dir))


@query("top_sell")
def top_sell(spark, sf_dir):
    return serving.top_sell(_wide(spark, sf_dir), 20, "LOW")


@query("next_single")
def next_single(spark, sf_dir):
    return serving.next_single(_wide(spark, sf_dir), "s7")


@query("forecast_single")
def forecast_single(spark, sf_dir):
    return serving.forecast_single(_wide(spark, sf_dir), "s7")


@query("market_summary")
def market_summary(spark, sf_dir):
    return serving.market_summary(_wide(spark, sf_dir))


@query("min_tier_set")
def min_tier_set(spark, sf_dir):
    return serving.min_tier_set(_wide(spark, sf_dir), "MEDIUM")


@query("forecast_day_counts")
def forecast_day_counts(spark, sf_dir):
    return serving.forecast_day_counts(published.read(spark, sf_dir, "long"))


@query("forecast_series")
def forecast_series(spark, sf_dir):
    return serving.forecast_series(published.read(spark, sf_dir, "long"))


@query("sorted_then_search")
def sorted_then_search(spark, sf_dir):
    return serving.sorted_then_search(_info(spark, sf_dir), "volume", "desc", " s2 ")


# Report tables


@query("day1_breadth")
def day1_breadth(spark, sf_dir):
    return _rounded(
        report.day1_breadth(_wide(spark, sf_dir)), "up_percent", "down_percent"
    )


@query("day1_top5")
def day1_top5(spark, sf_dir):
    return report.day1_top(_wide(spark, sf_dir))


@query("week_breadth")
def week_breadth(spark, sf_dir):
    return _rounded(report.week_breadth(_wide(spark, sf_dir)), "up_percent")


@query("recent_tail")
def recent_tail(spark, sf_dir):
    return report.recent_tail(published.read(spark, sf_dir, "features"))


@query("data_freshness")
def data_freshness(spark, sf_dir):
    return report.data_freshness(sample.raw_marked(spark, sf_dir), AS_OF)


@query("report_bundle")
def report_bundle(spark, sf_dir):
    """Row counts of every report table, with a scorer in the model's place."""
    tables = report.report_bundle(
        published.read(spark, sf_dir, "raw"),
        published.read(spark, sf_dir, "features"),
        _wide(spark, sf_dir),
        _model_runs(spark, sf_dir),
        models.feature_importance(spark, sample.BLEND),
        AS_OF,
    )
    counts = None
    for name, frame in tables.items():
        row = frame.agg(F.lit(name).alias("name"), F.count("*").alias("rows"))
        counts = row if counts is None else counts.unionByName(row)
    return counts


# Streaming


@query("stream_session_bar")
def stream_session_bar(spark, sf_dir):
    """Run the stream over the event files to the end and read the newest bars."""
    target = store.new_path(spark, "stream")
    bars = stream.session_bars(stream.read_ticks(spark, sf_dir))
    stream.run_available(bars, target, store.new_path(spark, "stream_state"))
    return stream.stored_bars(spark, target)
