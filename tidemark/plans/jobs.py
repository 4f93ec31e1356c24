"""Batch jobs: preprocessing, the daily run and the gated run."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import dates
from tidemark.operators import (
    clean,
    features,
    forecast,
    ingest,
    latest,
    metrics,
    models,
    report,
    scale,
)
from tidemark.sources import files, months, store
from tidemark.sources.months import MONTH, NO_MONTH

log = logging.getLogger(__name__)

Trainer = Callable[[DataFrame], Model]

# Bars of a task that makes feature rows of many, and so many tasks that the rows are not moved to their months any more:
# a task then has some ten thousand rows of each month, and the shuffle would be larger than the table.
TASK_ROWS, UNMOVED_TASKS = 2_000_000, 8


@dataclass(frozen=True)
class Paths:
    """Where one deployment keeps its datasets."""

    raw: str
    features: str
    info: str
    scaler: str
    models: str
    runs: str
    forecast: str
    state: str
    predictions: str

    @classmethod
    def under(cls, root: str, raw: str, **given: str) -> Paths:
        names = (
            "features", "info", "scaler", "models", "runs", "forecast", "state", "predictions"
        )
        return cls(raw, **{name: given.get(name, f"{root}/{name}") for name in names})


def preprocess(
    spark: SparkSession,
    paths: Paths,
    recent_days: int | None = None,
    collapse: bool = False,
    train_share: float | None = None,
    digits: int | None = None,
) -> dict[str, int]:
    """Raw bars to the scaled feature table and the latest price table.

    ``collapse`` merges the session bars of a day. By default all rows fit the scaler; with
    ``train_share`` only the oldest share does. The statistics are stored before they are used,
    and beside them the moments of each month.

    With ``recent_days``, once there is a feature table: only the months that reach so far back from
    the newest bar, or to the oldest month whose raw bars have changed since the last run, are
    computed and replaced (see ``refresh``). Raw bars without monthly folders are always read whole.
    """
    known = files.raw_facts(spark, paths.raw)
    # The state of the raw months that this run sees.
    source = store.staged(known.filter(F.col(MONTH) != NO_MONTH).select(MONTH, "files").distinct(), "source")
    if recent_days is not None and _refreshable(spark, paths, known):
        refresh(spark, paths, known, recent_days, collapse, train_share, digits)
    else:
        # The bars are kept, not their features, which are several times as wide and made twice from them.
        bars = store.staged(_bars(files.scan_raw(spark, paths.raw), collapse), "bars")
        tasks = bars.count() // TASK_ROWS
        moved = tasks < UNMOVED_TASKS
        rows = features.feature_rows(bars if moved else bars.repartition(tasks, "ticker"))
        _save_moments(rows, paths, whole=True)
        if train_share is not None:
            folds = metrics.time_split(rows, F.col("trade_date"), train_share)
            fitted = scale.scaler_stats(folds.filter("fold = 'train'"))
        else:
            fitted = scale.merge_moments(_moments(spark, paths))
        table = scale.feature_table(rows, _save_scaler(fitted, paths), digits)
        files.save_features(table, paths.features, moved)
        store.dropped(bars)
    source.write.mode("overwrite").parquet(_source_path(paths))
    _save_info(spark, paths)
    # Counted from the file footers; no column is read.
    return {"rows": files.scan_features(spark, paths.features).count()}


def refresh(
    spark: SparkSession,
    paths: Paths,
    known: DataFrame,
    days: int,
    collapse: bool = False,
    train_share: float | None = None,
    digits: int | None = None,
) -> None:
    """Recompute the feature rows of the newest months and replace those months only.

    Reads the touched months and, before them, the months that hold the bars which the
    windows of their tickers look back on, so that every new row equals that of a full run. The
    label of a ticker's last older bar may only now be known; months of the table that hold such a row are
    rewritten with it, all others stay as they are. New rows are scaled by the moments of all
    months, of which only those of the touched months are computed; with ``train_share``
    by the stored statistics. ``known`` holds the facts of the raw bars.
    """
    newest = known.agg(F.max("newest_date")).first()[0]
    start = f"{newest - timedelta(days=days):%Y-%m}"
    changed = known.filter(F.col(MONTH) != NO_MONTH).select(MONTH, "files").distinct()
    changed = changed.join(_source(spark, paths), [MONTH, "files"], "left_anti")
    start = min([start, *months.listed(changed)])
    first = date.fromisoformat(f"{start}-01")
    recent = known.filter((F.col(MONTH) >= start) & (F.col(MONTH) != NO_MONTH))
    stored = files.scan_raw_months(spark, paths.raw)
    columns = schemas.RAW_BARS.fieldNames()
    window = _bars(months.in_months(stored, months.listed(recent)).select(*columns), collapse)
    older = _halo(stored, known, recent.select("ticker").distinct(), start, collapse)
    bars = window if older is None else window.unionByName(older)
    day = F.col("trade_date")
    new = store.staged(features.feature_rows(bars).filter(day >= F.lit(first)), "feature-rows")
    _save_moments(new, paths, whole=False)
    if train_share is None:
        fitted = scale.merge_moments(_moments(spark, paths))
        scaler = _save_scaler(fitted, paths)
    else:
        scaler = scale.scaler_row_of(spark.read.schema(schemas.SCALER).parquet(paths.scaler))
    table = scale.feature_table(new, scaler, digits)
    if older is not None:
        relabelled = _relabelled(spark, paths, _last_labels(bars, first))
        table = table if relabelled is None else table.unionByName(relabelled)
    files.save_feature_months(table, paths.features)
    store.dropped(new)


def _bars(raw: DataFrame, collapse: bool) -> DataFrame:
    bars = clean.clean(raw)
    return clean.collapse_sessions(bars) if collapse else bars


def _refreshable(spark: SparkSession, paths: Paths, known: DataFrame) -> bool:
    """Whether there is a table to refresh and raw bars in monthly folders."""
    parts = paths.features, _moments_path(paths), _source_path(paths)
    there = all(files.exists(spark, path) for path in parts)
    return there and not known.filter(F.col(MONTH) != "").isEmpty()


def _source_path(paths: Paths) -> str:
    return f"{paths.features}_source"


def _source(spark: SparkSession, paths: Paths) -> DataFrame:
    """The state of the raw months that the feature table was made from."""
    return spark.read.schema(f"{MONTH} string, files string").parquet(_source_path(paths))


def _moments_path(paths: Paths) -> str:
    return f"{paths.scaler}_moments"


def _moments(spark: SparkSession, paths: Paths) -> DataFrame:
    schema = "feature string, n double, mean double, m2 double, month string"
    return spark.read.schema(schema).parquet(_moments_path(paths))


def _save_moments(rows: DataFrame, paths: Paths, whole: bool) -> None:
    found = scale.month_moments(rows, months.month_of(F.col("trade_date").cast("string")))
    months.write(found, _moments_path(paths), ["feature"], whole=whole)


def _save_scaler(fitted: DataFrame, paths: Paths) -> DataFrame:
    fitted.write.mode("overwrite").parquet(paths.scaler)
    spark = fitted.sparkSession
    return scale.scaler_row_of(spark.read.schema(schemas.SCALER).parquet(paths.scaler))


def _save_info(spark: SparkSession, paths: Paths) -> None:
    """The newest row of each ticker; needs no cleaned table: ties go to the larger close and volume."""
    ends = months.ending_rows(spark, paths.raw, schemas.RAW_BARS)
    newest = latest.newest_per_ticker(clean.canonical_dates(ends), ["date", "close", "volume"])
    newest.select(*schemas.STOCK_INFO.fieldNames()).write.mode("overwrite").parquet(paths.info)


def _halo(
    stored: DataFrame, known: DataFrame, tickers: DataFrame, start: str, collapse: bool
) -> DataFrame | None:
    """The cleaned bars before ``start`` that windows of these tickers look back on, or more of them.

    Key counts tell how many months each ticker needs. Rows that do not survive cleaning make
    them too few for some; then more months are asked for, until the bars suffice or end.
    """
    columns = schemas.RAW_BARS.fieldNames()
    # A collapsed bar has up to three keys.
    keys = schemas.LOOKBACK * (3 if collapse else 1)
    while True:
        pairs = months.halo(known, tickers, start, keys)
        wanted = months.listed(pairs)
        if not wanted:
            return None
        rows = months.in_months(stored, wanted).join(pairs, ["ticker", MONTH], "left_semi")
        bars = _bars(rows.select(*columns), collapse)
        unread = months.halo(known, tickers, start, 1 << 62).join(pairs, ["ticker", MONTH], "left_anti")
        enough = bars.groupBy("ticker").agg(F.count("*").alias("n")).filter(F.col("n") >= schemas.LOOKBACK)
        if unread.join(enough, "ticker", "left_anti").isEmpty():
            return bars
        keys *= 4


def _last_labels(bars: DataFrame, first: date) -> DataFrame:
    """``ticker, date, label`` of each ticker's last bar before a day."""
    day = F.col("trade_date")
    labelled = features.with_target(bars).filter(day < F.lit(first))
    key = dates.session_key(day, F.col("session"))
    last = F.max(F.struct(key.alias("date"), F.col("target").alias("label")))
    return labelled.groupBy("ticker").agg(last.alias("l")).select("ticker", "l.date", "l.label")


def _relabelled(spark: SparkSession, paths: Paths, labels: DataFrame) -> DataFrame | None:
    """The rows of all months of the table in which a label has changed, with the new labels."""
    labels = store.staged(labels.withColumn(MONTH, months.month_of(F.col("date"))), "labels")
    columns = schemas.FEATURE_TABLE.fieldNames()
    table = months.scan(spark, paths.features, schemas.FEATURE_TABLE)
    there = months.in_months(table, months.listed(labels))
    new = labels.drop(MONTH)
    changed = there.join(new, ["ticker", "date"]).filter(~F.col("target").eqNullSafe(F.col("label")))
    wanted = months.listed(changed)
    if not wanted:
        return None
    rows = months.in_months(table, wanted).join(new, ["ticker", "date"], "left")
    return rows.withColumn("target", F.coalesce("label", "target")).select(*columns)


def split_folds(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    folds = metrics.time_split(table, dates.date_part_of(F.col("date")))
    return folds.filter("fold = 'train'"), folds.filter("fold = 'test'")


def _params(model: Model) -> dict[str, str]:
    return {param.name: str(value) for param, value in model.extractParamMap().items()}


def train(
    table: DataFrame, trainer: Trainer, run_id: str, name: str, as_of: str
) -> tuple[Model, DataFrame]:
    """Fit on the older rows; the run's row of metrics comes from the newer ones."""
    older, newer = split_folds(table)
    started = time.perf_counter()
    model = trainer(older)
    seconds = time.perf_counter() - started
    # Both the counts and the area read the scores.
    scores = models.score(model, newer).select("target", "probability", "prediction")
    scores = store.staged(scores, "scores")
    params = [F.lit(text) for item in _params(model).items() for text in item]
    # The day is the one the job runs for, the time is the clock's.
    saved_at = f"{as_of} {datetime.now(timezone.utc):%H:%M:%S.%f}"
    run = metrics.evaluate(scores).select(
        F.lit(run_id).alias("run_id"),
        F.lit(name).alias("model"),
        "accuracy",
        "f1",
        "auc",
        F.lit(saved_at).cast("timestamp_ntz").alias("saved_at"),
        F.create_map(*params).alias("params"),
        F.lit(seconds).alias("train_seconds"),
    )
    return model, run


def champion_model(spark: SparkSession, paths: Paths) -> tuple[str, Model]:
    """Id and model of the run that the gate names."""
    gate = metrics.champion_gate(files.scan_metrics(spark, paths.runs))
    best = metrics.champion(gate).first()
    if best is None:
        raise ValueError("no run was ever promoted")
    return best["run_id"], models.load_model(f"{paths.models}/{best['run_id']}")


def newest_features(spark: SparkSession, paths: Paths) -> DataFrame:
    """The newest feature row of each ticker, read from the months in which tickers end."""
    return latest.latest_features(months.ending_rows(spark, paths.features, schemas.FEATURE_TABLE))


def _recent_rows(spark: SparkSession, path: str, days: int) -> DataFrame:
    """Feature rows of the last days; older months are not read."""
    known = months.facts(spark, path, schemas.FEATURE_TABLE)
    newest = known.agg(F.max("newest_date")).first()[0]
    if newest is None:
        return files.scan_features(spark, path)
    first = newest - timedelta(days=days)
    recent = known.filter((F.col(MONTH) >= f"{first:%Y-%m}") | (F.col(MONTH) == ""))
    rows = months.in_months(months.scan(spark, path, schemas.FEATURE_TABLE), months.listed(recent))
    return rows.filter(dates.date_part_of(F.col("date")) >= F.lit(first)).drop(MONTH)


def daily_job(
    spark: SparkSession,
    paths: Paths,
    as_of: str,
    trainer: Trainer = models.fit_gbt,
    name: str = "gbt",
    days: int = schemas.HORIZON,
    recent_days: int | None = None,
) -> dict:
    """Train, record the run, forecast with the champion, publish, report.

    With ``recent_days`` the model is fitted and measured on the rows so many days before the newest.

    Every run has an id and a model folder of its own, so a repeated day never touches
    the champion; the model that forecasts is always the one the gate names. A failed
    forecast is reported and does not undo the training; what was published before
    stays.
    """
    table = files.scan_features(spark, paths.features)
    run_id = f"{name}-{as_of}-{uuid.uuid4().hex[:8]}"
    rows = table if recent_days is None else _recent_rows(spark, paths.features, recent_days)
    model, run = train(rows, trainer, run_id, name, as_of)
    models.save_model(model, f"{paths.models}/{run_id}")
    files.save_metrics(run, paths.runs)
    runs = files.scan_metrics(spark, paths.runs)
    result: dict = {"status": "success", "run_id": run_id, "runs": runs, "gate": metrics.champion_gate(runs)}
    try:
        best, model = champion_model(spark, paths)
        newest = newest_features(spark, paths)
        entries = forecast.forecast(models.compiled(model), newest, as_of, days)
        files.publish(forecast.to_wide(entries, days), paths.forecast)
    except Exception as error:  # noqa: BLE001 - the run itself stays valid
        log.warning("forecast failed: %s", error)
        return result | {"forecast": "failed", "error": str(error)}
    wide = files.published(spark, paths.forecast, schemas.forecast_wide(days))
    importance = models.feature_importance(spark, model)
    raw = files.scan_raw(spark, paths.raw)
    tables = report.report_bundle(raw, table, wide, runs, importance, as_of)
    return result | {"champion": best, "forecast": "published", "wide": wide, "report": tables}


def ingest_job(
    spark: SparkSession,
    paths: Paths,
    as_of: str,
    universe: DataFrame,
    history: DataFrame,
    ticks: DataFrame,
    arrival: Sequence[str] = (),
    years: int = 5,
) -> dict[str, DataFrame]:
    """Bring the raw dataset up to date from what the vendor sent.

    ``history`` has vendor bars (``time`` first), of which only what the plan asks for
    is taken: days outside the whole plan are left out before anything is joined. ``ticks`` become session
    bars. Both are written once for the steps that read them. Plan and counts come from the facts of the
    stored months; only months with new bars are read. Returns the state found, the plan per
    ticker, and the counts of the merge. The first run creates the dataset.
    """
    found = files.raw_state(spark, paths.raw)
    found.write.mode("overwrite").parquet(f"{paths.state}/ingest_state")
    found = spark.read.schema(found.schema).parquet(f"{paths.state}/ingest_state")
    known = files.raw_facts(spark, paths.raw)
    dated = known.select("ticker", F.col("newest_date").alias("trade_date"))
    plan = ingest.fetch_plan(dated, universe, as_of, years)
    # The merge replaces what state, plan and counts are made from: they are written first.
    plan.write.mode("overwrite").parquet(f"{paths.state}/ingest_plan")
    plan = spark.read.schema(plan.schema).parquet(f"{paths.state}/ingest_plan")
    wanted = plan.filter("fetch_history").select("ticker", "history_start", "history_end")
    day = F.to_date("time")
    first = wanted.agg(F.min("history_start")).scalar()
    last = wanted.agg(F.max("history_end")).scalar()
    bars = history.filter(day.between(first, last)).join(wanted, "ticker").filter(
        (day >= F.col("history_start")) & (day <= F.col("history_end"))
    )
    bars = store.staged(ingest.normalize_history(bars), "ingest-history")
    intraday = ingest.to_raw(ingest.session_bars(ticks))
    intraday = store.staged(intraday.withColumn("volume", F.col("volume").cast("double")), "ingest-ticks")
    new = ingest.union_new(bars, intraday)
    touched = files.touched_raw(spark, paths.raw, new)
    untouched = known.join(
        F.broadcast(new.select(months.month_of(F.col("date")).alias(MONTH)).distinct()), MONTH, "left_anti"
    )
    counts = ingest.ingest_summary(touched, bars, intraday, untouched)
    counts.write.mode("overwrite").parquet(f"{paths.state}/ingest_summary")
    files.merge_raw(spark, paths.raw, new, arrival)
    counts = spark.read.schema(counts.schema).parquet(f"{paths.state}/ingest_summary")
    return {"found": found, "plan": plan, "summary": counts}


def next_session_job(
    spark: SparkSession, paths: Paths, as_of: str, model: Model | None = None
) -> DataFrame:
    """Score the newest bars for the next session and keep the result by target date.

    Uses the champion unless a model is given. The newest day of the stored history
    is the table that the questions about predictions read.
    """
    if model is None:
        _, model = champion_model(spark, paths)
    newest = newest_features(spark, paths)
    files.save_predictions(models.score_next(models.compiled(model), newest, as_of), paths.predictions)
    return files.scan_predictions(spark, paths.predictions)


def gated_job(
    spark: SparkSession,
    paths: Paths,
    as_of: str,
    trainer: Trainer = models.fit_gbt,
    name: str = "gbt",
    force: bool = False,
    recent_days: int | None = None,
) -> dict:
    """Preprocess and train only when the raw data is newer than the last run.

    With ``recent_days`` only the newest months of the feature table are computed anew, and
    the model is fitted on so many days. The state is stored once the forecast is published, so a
    day whose forecast failed is run again.
    """
    known = files.raw_facts(spark, paths.raw)
    state_schema = "latest_date string, last_processed_at string"
    try:
        state = spark.read.schema(state_schema).parquet(f"{paths.state}/gate")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        state = spark.createDataFrame([], state_schema)
    newest = known.agg(
        F.max("newest_key").alias("latest_date"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows")
    )
    gate = ingest.gate(newest, state, as_of, force=force).first()
    if not gate["success"]:
        return {"status": "failed", "error": "no dates in the raw data"}
    facts = {key: gate[key] for key in ("latest_date", "days_old", "has_new_data")}
    if not gate["should_run"]:
        return {"status": "skipped", "reason": "no_new_data", **facts}
    counted = preprocess(spark, paths, recent_days)
    if recent_days is None:
        # The table was written whole just now, with one row a key: the forecast needs its newest months.
        months.facts(spark, paths.features, schemas.FEATURE_TABLE, before=[])
    result = daily_job(spark, paths, as_of, trainer, name, recent_days=recent_days)
    if result["forecast"] == "published":
        spark.createDataFrame([(gate["latest_date"], as_of)], state_schema).write.mode(
            "overwrite"
        ).parquet(f"{paths.state}/gate")
    return {**result, **facts, **counted}
