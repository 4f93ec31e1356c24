"""One DuckDB statement per registered query that SQL can express."""

from __future__ import annotations

from oracles import blocks as b
from tidemark.plans.catalog import INGEST_DAY, RECENT_DAYS, REFRESHED_FROM, STORED_UNTIL
from tidemark.plans.published import AS_OF
from tidemark.schemas import FEATURES, HORIZON

_RAW_COLUMNS = "date, ticker, open, high, low, close, volume"


def _to_raw(source: str) -> str:
    return f"""SELECT strftime(trade_date, '%Y-%m-%d') || CASE session
  WHEN 1 THEN '(1)' WHEN 2 THEN '(2)' ELSE '' END AS date,
  ticker, open, high, low, close, CAST(volume AS DOUBLE) AS volume FROM {source}"""


def _feature(*columns: str) -> str:
    values = ", ".join(f"{b.rounded(name, 9)} AS {name}" for name in columns)
    return b.with_(b.bars(), b.features()) + f"SELECT ticker, trade_date, {values} FROM feats"


_ALL_FEATURES = ", ".join(f"{b.rounded(name, 9)} AS {name}" for name in FEATURES)
_KEPT = f"SELECT ticker, trade_date, close, target, {_ALL_FEATURES} FROM kept"
_TABLE = f"SELECT date, ticker, target, {b.SCALED_COLUMNS}, close FROM scaled"
_FEATURE_TABLE = b.with_(*b.CHAIN) + _TABLE
_LONG = "SELECT * FROM long"
_PREDS = """SELECT prediction_date, ticker, latest_data_date, predicted_for_date, prediction,
  signal, probability, confidence FROM {0}"""

_MERGED = f"""SELECT {_RAW_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY date, ticker ORDER BY src DESC) AS n FROM (
    SELECT 0 AS src, * FROM ({_to_raw('old_bars')})
    UNION ALL SELECT 1 AS src, * FROM ({_to_raw('new_bars')}))) WHERE n = 1"""
_OLD_NEW = (
    b.bars(where="l_linestatus = 'O'", name="old_bars"),
    b.bars(where="l_linestatus = 'F'", name="new_bars"),
)

# Rows of one key leave one; only the key matters to the facts.
_MERGED_MESSY = """SELECT DISTINCT date, ticker,
    CASE WHEN regexp_matches(date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
      THEN regexp_extract(date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') || CASE
        WHEN date LIKE '%(1)%' THEN '(1)' WHEN date LIKE '%(2)%' THEN '(2)' ELSE '' END
      END AS key FROM raw_messy"""

_CSV = ",\n  ".join(
    f"day_{d}_date AS Day{d}_Date, day_{d}_signal AS Day{d}_Signal, "
    f"printf('%.1f%%', day_{d}_probability * 100) AS Day{d}_Confidence, "
    f"day_{d}_confidence AS Day{d}_Level"
    for d in range(1, HORIZON + 1)
)
_CSV_VIEW = (
    b.with_(*b.WIDE_CHAIN, recursive=True)
    + f"SELECT ticker AS Ticker, latest_data_date AS Latest_Data, {_CSV} FROM wide"
)

_DAY_1 = """ticker, latest_data_date, day_1_date AS next_date, day_1_prediction AS prediction,
  day_1_signal AS signal, day_1_probability AS probability, day_1_confidence AS confidence"""
_RANKED = """ticker, day_1_date AS next_date, day_1_signal AS signal,
  day_1_probability AS probability, day_1_confidence AS confidence"""


def _history(select: str) -> str:
    return b.with_(*b.HISTORY_CHAIN) + select


def _wide(select: str) -> str:
    return b.with_(*b.WIDE_CHAIN, b.SLICE, recursive=True) + select


def _info(select: str) -> str:
    return b.with_(b.bars(), b.INFO) + select


def _percent(count: str) -> str:
    return b.rounded(
        f"CASE WHEN total > 0 THEN CAST({count} AS DOUBLE) / total * 100.0 ELSE 0.0 END", 1
    ) + f" AS {count}_percent"


def _stack(source: str, fit: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature, {b.rounded(f'avg({name})', 8)} AS mean, "
        f"{b.rounded(f'stddev_samp({name})', 8)} AS std FROM {fit}"
        for name in FEATURES
    )


_TRAIN_FIT = """daily_rows AS (
  SELECT trade_date, count(*) AS n FROM kept WHERE target IS NOT NULL GROUP BY 1),
fit AS (
  SELECT * FROM kept WHERE target IS NOT NULL AND trade_date < (
    SELECT min(trade_date) FROM (
      SELECT trade_date, sum(n) OVER (ORDER BY trade_date) AS upto, sum(n) OVER () AS total
      FROM daily_rows) WHERE upto > floor(total * CAST(0.8 AS DOUBLE))))"""

_PLAN_COLUMNS = """strategy, strategy <> 'intraday' AS fetch_history, true AS fetch_intraday,
  CASE strategy WHEN 'full' THEN CAST({day} - 1825 AS DATE)
    WHEN 'gap' THEN CAST(last_date + 1 AS DATE) END AS history_start,
  CASE WHEN strategy <> 'intraday' THEN CAST({day} - 1 AS DATE) END AS history_end"""


def _strategy(day: str) -> str:
    return f"""CASE WHEN last_date IS NULL THEN 'full' WHEN last_date < {day} - 1 THEN 'gap'
    ELSE 'intraday' END AS strategy"""


_INGEST = f"DATE '{INGEST_DAY}'"
_TODAY = f"DATE '{AS_OF}'"


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Sources and sinks
    sql["scan_raw"] = b.with_(b.bars()) + _to_raw("bars")
    sql["scan_features"] = sql["sink_features"] = sql["feature_table"] = _FEATURE_TABLE
    sql["scan_drift_union"] = b.with_(b.bars()) + """
      SELECT strftime(trade_date, '%Y-%m-%d') || CASE WHEN k = 1 THEN ' 00:00:00' ELSE '' END
          AS date, ticker, open, high, low, close,
        CASE WHEN k <> 1 THEN volume END AS volume, CASE WHEN k = 2 THEN 'vendor' END AS source
      FROM (SELECT *, CAST(substr(ticker, 2) AS BIGINT) % 3 AS k FROM bars)"""
    sql["sink_raw"] = sql["upsert_keep_last"] = b.with_(*_OLD_NEW) + _MERGED
    sql["sink_table"] = _info("SELECT * FROM info")
    sql["universe_filter"] = b.with_(b.bars()) + """
      SELECT * FROM bars WHERE ticker IN (
        SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal > 5000)"""
    sql["universe_missing"] = """SELECT 'S' || c_custkey AS ticker FROM customer
      WHERE c_custkey NOT IN (SELECT l_suppkey FROM lineitem)"""
    for key in ("sink_pred_by_date", "scan_pred_history"):
        sql[key] = _history(_PREDS.format("history"))
    sql["csv_export"] = sql["forecast_csv_view"] = _CSV_VIEW
    sql["csv_scan"] = _info("SELECT ticker, close AS close_price, volume FROM info")
    sql["csv_scan_signals"] = _history(
        "SELECT ticker, signal, probability AS confidence FROM newest"
    )
    sql["metrics_io"] = sql["model_runs"] = b.with_(*b.RUNS_CHAIN) + "SELECT * FROM runs"
    sql["snapshot_sync"] = sql["forecast_wide"] = (
        b.with_(*b.WIDE_CHAIN, recursive=True) + "SELECT * FROM wide"
    )

    # Ingestion
    sql["normalize_history"] = b.with_(b.bars("day")) + _to_raw("bars")
    sql["session_of_time"] = """
      SELECT event_id, CAST(CASE WHEN t >= TIME '09:00:00' AND t < TIME '13:30:00'
          THEN 1 ELSE 2 END AS INTEGER) AS session,
        CAST(CASE WHEN u >= TIME '09:00:00' AND u < TIME '13:30:00'
          THEN 1 ELSE 2 END AS INTEGER) AS session_from_utc
      FROM (SELECT event_id, CAST(ts AS TIME) AS t,
        CAST(ts + INTERVAL 7 HOUR AS TIME) AS u FROM events)"""
    sql["session_filter"] = b.with_(b.TICKS) + f"SELECT * FROM ticks WHERE {b.IN_SESSION}"
    sql["session_bar"] = b.with_(b.TICKS, b.SESSION_BARS) + "SELECT * FROM session_bars"
    sql["last_date"] = """SELECT count(*) > 0 AS has_rows,
      CAST(max(l_shipdate) AS DATE) AS last_date FROM lineitem"""
    sql["union_new"] = (
        b.with_(b.bars("day"), b.TICKS, b.SESSION_BARS)
        + _to_raw("bars") + " UNION ALL " + _to_raw("session_bars")
    )
    sql["sort_bars"] = b.with_(b.bars("day"), b.RAW_MARKED) + "SELECT * FROM raw_marked"
    sql["fetch_plan"] = b.with_(b.bars("day")) + f"""
      SELECT ticker, last_date, {_PLAN_COLUMNS.format(day=_INGEST)} FROM (
        SELECT *, {_strategy(_INGEST)} FROM (
          SELECT 'S' || c_custkey AS ticker FROM customer) LEFT JOIN (
          SELECT ticker, max(trade_date) AS last_date FROM bars GROUP BY 1) USING (ticker))"""
    sql["fetch_plan_all"] = f"""
      SELECT last_date, {_PLAN_COLUMNS.format(day=_TODAY)} FROM (
        SELECT *, {_strategy(_TODAY)} FROM (
          SELECT CAST(max(l_shipdate) AS DATE) AS last_date FROM lineitem))"""
    sql["recent_days"] = b.with_(b.bars("day")) + """
      SELECT * FROM bars WHERE trade_date >= (SELECT max(trade_date) - 30 FROM bars)"""
    sql["freshness_gate"] = b.with_(b.RAW_MESSY, b.CANONICAL) + f"""
      , seen AS (SELECT strftime(max(date_trunc('month', l_shipdate)), '%Y-%m-%d') AS d
        FROM lineitem WHERE l_linestatus = 'O')
      SELECT max(date) AS latest_date, count(*) AS total_rows, max(seen.d) AS cached_date,
        CAST({_TODAY} - CAST(substr(max(date), 1, 10) AS DATE) AS INTEGER) AS days_old,
        max(date) > max(seen.d) AS has_new_data, max(date) > max(seen.d) AS should_run,
        count(*) > 0 AS success, max(seen.d) AS last_processed_at
      FROM canonical, seen"""
    sql["ingest_summary"] = b.with_(*_OLD_NEW, b.TICKS, b.SESSION_BARS) + f"""
      SELECT CAST(count(*) FILTER (src = 1) AS BIGINT) AS history_rows,
        count(*) FILTER (src = 2) AS intraday_rows, count(*) FILTER (src > 0) AS new_rows,
        count(*) FILTER (src = 0) AS existing_rows, count(*) AS merged_rows,
        count(DISTINCT (date, ticker)) AS deduped_rows
      FROM (SELECT 0 AS src, * FROM ({_to_raw('old_bars')})
        UNION ALL SELECT 1, * FROM ({_to_raw('new_bars')})
        UNION ALL SELECT 2, * FROM ({_to_raw('session_bars')}))"""

    # Cleaning
    messy = b.with_(b.RAW_MESSY, b.CANONICAL)
    sql["canon_date"] = messy + "SELECT * FROM canonical"
    sql["quarantine"] = b.with_(b.RAW_MESSY) + "SELECT * FROM raw_messy WHERE date = 'n/a'"
    sql["strip_marker"] = b.with_(b.RAW_MESSY) + """
      SELECT ticker, date, TRY_CAST(substr(date, 1, 10) AS DATE) AS trade_date FROM raw_messy"""
    sql["drop_nulls"] = (
        messy + "SELECT * FROM canonical WHERE date IS NOT NULL AND volume IS NOT NULL"
    )
    sql["dedup_rows"] = messy + "SELECT DISTINCT * FROM canonical"
    sql["dedup_keys"] = b.with_(b.RAW_MESSY, b.CANONICAL, b.CLEAN) + "SELECT * FROM cleaned"
    sql["collapse_sessions"] = b.with_(b.RAW_MESSY, b.CANONICAL, b.CLEAN) + """
      SELECT ticker, trade_date, CAST(0 AS INTEGER) AS session,
        arg_min(open, session) AS open,
        CASE WHEN min(session) = 0 THEN arg_min(high, session) ELSE max(high) END AS high,
        CASE WHEN min(session) = 0 THEN arg_min(low, session) ELSE min(low) END AS low,
        CASE WHEN min(session) = 0 THEN arg_min(close, session) ELSE arg_max(close, session) END
          AS close,
        CASE WHEN min(session) = 0 THEN arg_min(volume, session) ELSE sum(volume) END AS volume
      FROM cleaned GROUP BY ticker, trade_date"""
    sql["profile"] = messy + """, whole AS (
        SELECT * FROM canonical WHERE date IS NOT NULL AND volume IS NOT NULL),
      counts AS (SELECT (SELECT count(*) FROM canonical) AS rows,
        (SELECT count(DISTINCT ticker) FROM canonical) AS tickers,
        CAST(7 AS INTEGER) AS columns,
        (SELECT count(*) FROM whole) AS rows_without_nulls,
        (SELECT count(*) FROM (SELECT DISTINCT * FROM whole)) AS rows_distinct)
      SELECT *, rows - rows_without_nulls AS removed_nulls,
        rows_without_nulls - rows_distinct AS removed_duplicates FROM counts"""
    sql["sample_keys"] = b.with_(b.bars("day"), b.RAW_MARKED) + """
      SELECT DISTINCT date FROM raw_marked ORDER BY date LIMIT 5"""

    # Features
    sql["f_lags"] = _feature(
        "prev_close_1", "prev_close_3", "prev_close_5", "prev_close_10", "prev_volume_1"
    )
    sql["f_ma"] = _feature("ma5", "ma10")
    sql["f_avg_vol20"] = _feature("avg_vol20")
    sql["f_return_lags"] = _feature("return_lag1", "return_lag2", "return_lag3")
    for name in FEATURES:
        if not name.startswith("return_lag"):
            sql[f"f_{name}"] = _feature(name)
    sql["features_all"] = b.with_(b.bars(), b.features()) + _KEPT
    sql["features_split"] = b.with_(b.bars("day"), b.features()) + _KEPT

    # Labels and scaling
    sql["target_label"] = b.with_(b.bars("day"), b.features()) + """
      SELECT ticker, trade_date, close, target FROM feats"""
    sql["target_dist"] = b.with_(b.bars("day"), b.features()) + f"""
      SELECT target, CASE target WHEN 1 THEN 'UP' ELSE 'DOWN' END AS label, count(*) AS rows,
        {b.rounded('CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100.0', 9)} AS percent
      FROM feats WHERE target IS NOT NULL GROUP BY target"""
    sql["scaler_stats"] = b.with_(b.bars(), b.features()) + _stack("kept", "kept")
    sql["zscore"] = b.with_(*b.CHAIN) + f"SELECT ticker, trade_date, {b.SCALED_COLUMNS} FROM scaled"
    sql["zscore_train"] = b.with_(b.bars(), b.features(), _TRAIN_FIT, b.scaled("fit")) + (
        f"SELECT ticker, trade_date, {b.SCALED_COLUMNS} FROM scaled"
    )
    sql["feature_table_daily"] = b.with_(b.bars("day"), b.features(), b.scaled()) + _TABLE
    sql["preprocess_job"] = (
        b.with_(b.RAW_MESSY, b.CANONICAL, b.CLEAN, b.features("cleaned"), b.scaled()) + _TABLE
    )
    recent = f"trade_date >= (SELECT date_trunc('month', least(max(trade_date) - {RECENT_DAYS}, DATE '{REFRESHED_FROM}')) FROM bars)"
    recent_scaled = ", ".join(f"CASE WHEN {recent} THEN {n}_scaled END AS {n}_scaled" for n in FEATURES)
    sql["preprocess_recent"] = b.with_(b.bars("day"), b.features(), b.scaled()) + f"""
      SELECT date, ticker, target, {recent_scaled}, close FROM scaled"""
    sql["month_facts"] = b.with_(b.RAW_MESSY, b.CANONICAL, "stored AS (" + _MERGED_MESSY + ")") + """
      SELECT coalesce(left(key, 7), 'unreadable') AS month, ticker, count(*) AS rows,
        count(DISTINCT coalesce(date, '')) AS keys, max(key) AS newest_key,
        CAST(left(max(key), 10) AS DATE) AS newest_date
      FROM stored GROUP BY 1, 2"""
    sql["scaler_by_months"] = b.with_(b.bars("day"), b.features()) + _stack("kept", "kept")

    sql["mirror_sync"] = b.with_(b.bars("day")) + _to_raw("bars")

    # Newest rows
    sql["latest_by_months"] = b.with_(b.bars("day"), b.RAW_MARKED) + """
      SELECT ticker, close, volume, date FROM raw_marked
      QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1"""
    sql["latest_price_volume"] = b.with_(b.bars("day"), b.RAW_MARKED) + """
      SELECT ticker, close, volume, date FROM raw_marked
      QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1"""
    sql["latest_features"] = b.with_(*b.CHAIN, b.LATEST) + f"""
      SELECT date, ticker, target, {b.SCALED_COLUMNS}, close, latest_data_date FROM latest"""
    sql["latest_dates"] = b.with_(*b.CHAIN, b.LATEST) + """
      SELECT max(latest_data_date) AS latest_date, count(DISTINCT ticker) AS tickers FROM latest"""

    # Models
    sql["time_split"] = b.with_(*b.CHAIN, b.SPLIT) + "SELECT ticker, date, target, fold FROM folds"
    test = b.with_(*b.CHAIN, b.SPLIT, b.SCORED_TEST)
    sql["eval_accuracy"] = test + f"SELECT {b.rounded(b.ACCURACY, 9)} AS accuracy FROM scored"
    sql["eval_f1"] = test + f"SELECT {b.rounded(b.F1, 9)} AS f1 FROM scored"
    sql["eval_auc"] = b.with_(*b.CHAIN, b.SPLIT, b.SCORED_TEST, b.auc()) + (
        f"SELECT {b.rounded('auc', 9)} AS auc FROM areas"
    )
    sql["champion_gate"] = b.with_(*b.RUNS_CHAIN) + f""", numbered AS (
        SELECT *, CAST(row_number() OVER (ORDER BY saved_at, run_id) AS INTEGER) AS run_no
        FROM runs),
      met AS (SELECT n.*, c.run_id AS previous_champion, c.auc AS old_auc,
          c.accuracy AS old_accuracy, c.f1 AS old_f1
        FROM numbered n LEFT JOIN numbered c ON c.run_no < n.run_no
        QUALIFY row_number() OVER (PARTITION BY n.run_no ORDER BY c.auc DESC NULLS LAST,
          c.run_no) = 1)
      SELECT run_no, run_id, accuracy, f1, auc, previous_champion,
        {b.rounded('auc - old_auc', 9)} AS auc_change,
        {b.rounded('accuracy - old_accuracy', 9)} AS accuracy_change,
        {b.rounded('f1 - old_f1', 9)} AS f1_change,
        auc IS NOT NULL AND coalesce(auc > old_auc, true) AS promoted FROM met"""
    sql["model_leaderboard"] = b.with_(*b.CHAIN, b.ALL_SCORES, b.auc("model")) + f"""
      , board AS (SELECT model, {b.rounded('accuracy', 9)} AS accuracy,
          {b.rounded('f1', 9)} AS f1, {b.rounded('auc', 9)} AS auc FROM (
        SELECT model, {b.ACCURACY} AS accuracy, {b.F1} AS f1 FROM scored GROUP BY 1)
        JOIN areas USING (model))
      SELECT model, {b.rounded('accuracy', 4)} AS accuracy, {b.rounded('f1', 4)} AS f1,
        {b.rounded('auc', 4)} AS auc,
        row_number() OVER (ORDER BY board.auc DESC, model DESC) = 1 AS is_best FROM board"""
    sql["confidence_tier"] = b.with_(*b.CHAIN) + f"""
      SELECT ticker, date, probability, {b.TIER} AS confidence FROM (
        SELECT *, {b.probability(0)} AS probability FROM scaled)"""
    sql["trading_calendar"] = f"""
      WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS as_of FROM lineitem),
      ahead AS (
        SELECT as_of, CAST(as_of + CAST(g AS INTEGER) AS DATE) AS date
        FROM days, generate_series(1, 34) AS s(g)),
      ranked AS (
        SELECT as_of, date,
          CAST(row_number() OVER (PARTITION BY as_of ORDER BY date) AS INTEGER) AS day
        FROM ahead WHERE isodow(date) < 6)
      SELECT as_of, min(date) OVER (PARTITION BY as_of) AS next_date, day, date
      FROM ranked WHERE day <= {HORIZON}"""
    sql["score_next"] = b.with_(*b.CHAIN, b.LATEST) + f"""
      SELECT {_TODAY} AS prediction_date, ticker, latest_data_date,
        {b.NEXT_DAY.format(_TODAY)} AS predicted_for_date,
        CAST(CASE WHEN probability > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS INTEGER)
          AS prediction,
        CASE WHEN probability > CAST(0.5 AS DOUBLE) THEN 'UP' ELSE 'DOWN' END AS signal,
        probability, {b.TIER} AS confidence
      FROM (SELECT *, {b.probability(0)} AS probability FROM latest)"""
    step = ", ".join(
        f"{b.rounded(b.rolled(name), 9)} AS {name}_scaled" for name in FEATURES
    )
    sql["rollforward_step"] = b.with_(*b.CHAIN, b.LATEST) + f"""
      SELECT ticker, CAST(CASE WHEN s > 0 THEN 1 ELSE 0 END AS INTEGER) AS prediction, {step}
      FROM (SELECT *, CAST(CASE WHEN {b.probability(0)} > CAST(0.5 AS DOUBLE) THEN 1 ELSE -1
        END AS DOUBLE) AS s FROM latest)"""
    sql["forecast_15d"] = sql["forecast_long"] = (
        b.with_(*b.FORECAST_CHAIN, recursive=True) + _LONG
    )
    sql["forecast_15d_floor"] = (
        b.with_(*b.CHAIN, b.LATEST, b.forecast(0.62), recursive=True) + _LONG
    )
    aligned = ", ".join(
        f"CAST(0 AS DOUBLE) AS {name}_scaled"
        if name in ("volatility_5", "return_lag3")
        else f"{name}_scaled"
        for name in FEATURES
    )
    sql["align_features"] = b.with_(*b.CHAIN) + f"SELECT ticker, date, {aligned} FROM scaled"
    sql["align_by_position"] = b.with_(b.bars()) + """
      SELECT open, high, low, close, volume, CAST(0 AS DOUBLE) AS feat_5,
        CAST(0 AS DOUBLE) AS feat_6 FROM bars"""

    # Predictions of the next session
    sql["pred_latest"] = _history(_PREDS.format("newest"))
    sql["pred_for_ticker"] = _history(_PREDS.format("newest") + " WHERE ticker = 'S5'")
    sql["pred_by_signal"] = _history(_PREDS.format("newest") + " WHERE prediction = 1")
    sql["pred_high_conf"] = _history(_PREDS.format("newest") + " WHERE confidence = 'HIGH'")
    since = " WHERE prediction_date >= DATE '2001-09-15' - 365"
    sql["pred_history"] = _history(_PREDS.format("history") + since)
    sql["pred_history_ticker"] = _history(
        _PREDS.format("history") + since + " AND ticker = 'S7'"
    )
    sql["pred_summary"] = _history(f"""
      SELECT *, {_percent('up')}, {_percent('down')}, {_percent('high')}, {_percent('medium')},
        {_percent('low')} FROM (
        SELECT max(prediction_date) AS prediction_date,
          max(predicted_for_date) AS predicted_for_date, count(*) AS total,
          count(*) FILTER (prediction = 1) AS up, count(*) FILTER (prediction = 0) AS down,
          count(*) FILTER (confidence = 'HIGH') AS high,
          count(*) FILTER (confidence = 'MEDIUM') AS medium,
          count(*) FILTER (confidence = 'LOW') AS low FROM newest)""")
    sql["pred_top_up"] = _history("""SELECT ticker, probability, confidence FROM newest
      WHERE prediction = 1 ORDER BY probability DESC, ticker LIMIT 10""")
    sql["pred_top_up_high"] = _history("""SELECT ticker, probability, confidence FROM newest
      WHERE prediction = 1 AND confidence = 'HIGH' ORDER BY probability DESC, ticker LIMIT 10""")
    sql["pred_top_down"] = _history(f"""
      SELECT ticker, {b.rounded('CAST(1.0 AS DOUBLE) - probability', 9)} AS probability, confidence
      FROM (SELECT * FROM newest WHERE prediction = 0 ORDER BY probability, ticker LIMIT 10)""")

    # Serving
    sql["stock_list"] = _info("SELECT * FROM info ORDER BY ticker LIMIT 50")
    sql["asof_latest_slice"] = _wide(
        "SELECT ticker, latest_data_date, day_1_prediction, day_1_probability FROM slice"
    )
    sql["stock_search"] = _info(
        "SELECT * FROM info WHERE ticker ILIKE '%s1%' ORDER BY ticker LIMIT 50"
    )
    sql["stock_sorted_page"] = _info(
        "SELECT * FROM info ORDER BY close DESC, ticker LIMIT 10 OFFSET 20"
    )
    sql["stock_sorted_volume"] = _info("SELECT * FROM info ORDER BY volume, ticker LIMIT 25")
    sql["stock_count"] = _info("SELECT count(*) AS total FROM info")
    sql["sync_status"] = _wide("""SELECT max(latest_data_date) AS latest_data_date,
      count(DISTINCT ticker) AS total_predicted_tickers,
      CASE WHEN max(latest_data_date) IS NULL THEN 'UNHEALTHY' ELSE 'HEALTHY' END AS status
      FROM wide""")
    mean = "(day_1_probability + day_2_probability + day_3_probability) / 3"
    sql["recommendations"] = _wide(f"""
      SELECT ticker, {b.rounded(mean, 3)} AS average_probability FROM slice
      WHERE day_1_prediction = 1 AND day_2_prediction = 1 AND day_3_prediction = 1
      ORDER BY average_probability DESC, ticker LIMIT 5""")
    sql["next_batch"] = _wide(f"SELECT {_DAY_1} FROM slice")
    sql["next_batch_list"] = _wide(f"""SELECT {_DAY_1} FROM slice
      WHERE ticker IN ('S1', 'S2', 'S3', 'S5', 'S8', 'S13', 'S21', 'S34')""")
    sql["next_batch_table"] = _wide(f"""SELECT {_DAY_1} FROM slice WHERE ticker IN (
      SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal > 5000)""")
    sql["top_buy"] = _wide(f"""SELECT {_RANKED} FROM slice WHERE day_1_prediction = 1
      AND day_1_confidence IN ('MEDIUM', 'HIGH')
      ORDER BY day_1_probability DESC, ticker LIMIT 10""")
    sql["top_sell"] = _wide(f"""SELECT {_RANKED} FROM slice WHERE day_1_prediction = 0
      ORDER BY day_1_probability, ticker LIMIT 20""")
    sql["next_single"] = _wide(f"""SELECT {_DAY_1} FROM wide WHERE ticker = 'S7'
      ORDER BY latest_data_date DESC LIMIT 1""")
    sql["forecast_single"] = (
        b.with_(*b.FORECAST_CHAIN, recursive=True) + "SELECT * FROM long WHERE ticker = 'S7'"
    )
    sql["market_summary"] = _wide(f"""
      SELECT *, {b.rounded('100.0 - up_percent', 2)} AS down_percent,
        CASE WHEN up_percent >= 55 THEN 'BULLISH' WHEN up_percent <= 45 THEN 'BEARISH'
          ELSE 'NEUTRAL' END AS market_sentiment
      FROM (SELECT *, {b.rounded('CAST(up_count AS DOUBLE) / total_tickers * 100.0', 2)}
          AS up_percent
        FROM (SELECT count(*) AS total_tickers, max(day_1_date) AS next_session_date,
          count(*) FILTER (day_1_prediction = 1) AS up_count,
          count(*) FILTER (day_1_prediction = 0) AS down_count,
          count(*) FILTER (day_1_confidence = 'HIGH') AS high_count,
          count(*) FILTER (day_1_confidence = 'MEDIUM') AS medium_count,
          count(*) FILTER (day_1_confidence = 'LOW') AS low_count,
          {b.rounded('avg(day_1_probability)', 4)} AS avg_probability FROM slice))""")
    sql["min_tier_set"] = _wide("""
      SELECT ticker, day_1_confidence AS confidence,
        CAST(CASE day_1_confidence WHEN 'HIGH' THEN 2 ELSE 1 END AS INTEGER) AS rank
      FROM slice WHERE day_1_confidence <> 'LOW'""")
    forecasted = b.with_(*b.FORECAST_CHAIN, recursive=True)
    sql["forecast_day_counts"] = forecasted + """
      SELECT ticker, count(*) FILTER (prediction = 1) AS up_days,
        count(*) FILTER (prediction = 0) AS down_days,
        count(*) FILTER (confidence = 'HIGH') AS high_days FROM long GROUP BY 1"""
    sql["forecast_series"] = forecasted + f"""
      SELECT ticker, 'D' || day AS day, date, {b.rounded('probability * 100.0', 2)} AS probability,
        prediction, signal, confidence FROM long"""
    sql["sorted_then_search"] = _info("""
      SELECT * FROM (SELECT * FROM info ORDER BY volume DESC, ticker LIMIT 100)
      WHERE contains(upper(ticker), 'S2') ORDER BY volume DESC, ticker LIMIT 50""")

    # Report tables
    sql["day1_breadth"] = _wide(f"""
      SELECT date, total, up, down, {b.rounded('p', 9)} AS up_percent,
        {b.rounded('100.0 - p', 9)} AS down_percent,
        CASE WHEN p > 60 THEN 'UPTREND' WHEN p < 40 THEN 'DOWNTREND' ELSE 'SIDEWAYS' END
          AS sentiment
      FROM (SELECT *, CAST(up AS DOUBLE) / total * 100.0 AS p FROM (
        SELECT max(day_1_date) AS date, count(*) AS total,
          count(*) FILTER (day_1_prediction = 1) AS up,
          count(*) FILTER (day_1_prediction = 0) AS down FROM wide))""")
    top = """SELECT day_1_signal AS side, CAST(row_number() OVER (
        ORDER BY day_1_probability {0}, ticker) AS INTEGER) AS rank, ticker,
      day_1_probability AS probability, day_1_confidence AS confidence
      FROM wide WHERE day_1_prediction = {1} QUALIFY rank <= 5"""
    sql["day1_top5"] = _wide(
        f"({top.format('DESC', 1)}) UNION ALL ({top.format('ASC', 0)})"
    )
    sql["week_breadth"] = forecasted + f"""
      SELECT day, date, up, down, {b.rounded('p', 9)} AS up_percent,
        CASE WHEN p > 55 THEN 'UP' WHEN p < 45 THEN 'DOWN' ELSE 'SIDEWAYS' END AS trend
      FROM (SELECT *, CAST(up AS DOUBLE) / (up + down) * 100.0 AS p FROM (
        SELECT day, date, count(*) FILTER (prediction = 1) AS up,
          count(*) FILTER (prediction = 0) AS down FROM long WHERE day <= 5 GROUP BY 1, 2))"""
    sql["recent_tail"] = b.with_(*b.CHAIN) + """
      SELECT ticker, date, value, CAST(row_number() OVER (
        PARTITION BY ticker ORDER BY date) AS INTEGER) AS position
      FROM (SELECT ticker, date, volume_ratio_scaled AS value FROM scaled
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 30)"""
    sql["data_freshness"] = b.with_(b.bars("day")) + f"""
      SELECT *, CASE WHEN days_old = 0 THEN 'TODAY' WHEN days_old = 1 THEN 'YESTERDAY'
        WHEN days_old <= 2 THEN 'RECENT' ELSE 'STALE' END AS freshness
      FROM (SELECT count(*) AS total_rows, max(trade_date) AS latest_date,
        CAST({_TODAY} - max(trade_date) AS INTEGER) AS days_old FROM bars)"""
    sql["report_bundle"] = b.with_(
        *b.WIDE_CHAIN, b.ALL_SCORES, b.RUNS, recursive=True
    ) + """
      SELECT 'day1_breadth' AS name, CAST(1 AS BIGINT) AS rows
      UNION ALL SELECT 'day1_top', least(5, count(*) FILTER (day_1_prediction = 1))
        + least(5, count(*) FILTER (day_1_prediction = 0)) FROM wide
      UNION ALL SELECT 'week_breadth', count(DISTINCT day) FROM long WHERE day <= 5
      UNION ALL SELECT 'recent_tail', CAST(sum(least(n, 30)) AS BIGINT)
        FROM (SELECT count(*) AS n FROM scaled GROUP BY ticker)
      UNION ALL SELECT 'data_freshness', 1
      UNION ALL SELECT 'feature_importance', 3
      UNION ALL SELECT 'metrics', count(*) FROM runs
      UNION ALL SELECT 'forecast_csv', count(*) FROM wide"""

    # Jobs
    sql["gated_job"] = b.with_(b.RAW_MESSY, b.CANONICAL, b.CLEAN, b.features("cleaned")) + f"""
      , newest AS (SELECT max(date) AS date FROM canonical),
      made AS (SELECT count(*) AS n, count(DISTINCT ticker) AS tickers FROM kept)
      SELECT CAST(run AS INTEGER) AS run,
        CASE run WHEN 1 THEN 'success' ELSE 'skipped' END AS status, date AS latest_date,
        CAST({_TODAY} - CAST(substr(date, 1, 10) AS DATE) AS INTEGER) AS days_old,
        run = 1 AS has_new_data, made.n AS feature_rows, made.tickers AS forecast_rows
      FROM newest, made, (VALUES (1), (2)) AS r(run)"""
    sql["next_session_job"] = sql["score_next"]
    zero = "CAST(0 AS BIGINT) AS bad_probability, CAST(0 AS BIGINT) AS bad_class"
    fitted = " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows, count(DISTINCT ticker) AS tickers, {zero} FROM folds WHERE fold = 'test'"
        for name in ("train_gbt", "train_lr", "train_rf")
    )
    rolled = " UNION ALL ".join(
        f"SELECT '{name}', {days} * count(DISTINCT ticker), count(DISTINCT ticker), {zero} FROM scaled"
        for name, days in (
            ("score_next_gbt", 1), ("forecast_15d_gbt", HORIZON), ("forecast_15d_lr", HORIZON), ("next_session_champion", 1),
        )
    )
    sql["model_checks"] = b.with_(*b.CHAIN, b.SPLIT) + f"{fitted} UNION ALL {rolled}"

    def shown(value: str) -> str:
        text = f"printf('%.3f', round(abs({value}), 3))"
        whole = f"replace(format('{{:,}}', CAST(split_part({text}, '.', 1) AS BIGINT)), ',', '.')"
        sign = f"CASE WHEN round({value}, 3) < 0 THEN '-' ELSE '' END"
        return f"{sign} || regexp_replace({whole} || ',' || split_part({text}, '.', 2), ',?0+$', '')"

    sql["number_text"] = _info(f"SELECT ticker, {shown('close')} AS close, {shown('volume * 1000')} AS volume FROM info")
    sql["ingest_job"] = b.with_(b.bars("day"), b.TICKS, b.SESSION_BARS) + f"""
      , stored AS (SELECT * FROM bars WHERE trade_date < DATE '{STORED_UNTIL}'),
      newest AS (SELECT ticker, max(trade_date) AS last FROM stored GROUP BY 1),
      plan AS (SELECT 'S' || s_suppkey AS ticker, last FROM supplier
        LEFT JOIN newest ON newest.ticker = 'S' || s_suppkey WHERE s_acctbal > 5000),
      wanted AS (SELECT bars.* FROM bars JOIN plan USING (ticker)
        WHERE trade_date < DATE '{INGEST_DAY}' AND CASE WHEN last IS NULL
            THEN trade_date >= DATE '{INGEST_DAY}' - 5 * 365
          ELSE last < DATE '{INGEST_DAY}' - 1 AND trade_date > last END)
      {_to_raw("(SELECT ticker, trade_date, session, open, high, low, close, volume FROM stored")}
        UNION ALL SELECT ticker, trade_date, session, open, high, low, close, volume FROM wanted
        UNION ALL SELECT ticker, trade_date, session, open, high, low, close, volume
          FROM session_bars)"""

    # Streaming
    sql["stream_session_bar"] = b.with_(b.TICKS, b.SESSION_BARS) + "SELECT * FROM session_bars"
    return sql
