"""Common table expressions that the oracle statements are put together from."""

from __future__ import annotations

from tidemark.plans.published import AS_OF
from tidemark.schemas import DAY_FIELDS, FEATURES, HORIZON
from tidemark.sources.sample import SCORERS


def rounded(value: str, digits: int) -> str:
    """Round without a negative zero.

    Values shown with a few digits round halves up. Values stored with six digits
    and more round as the library does it, in double arithmetic with halves to even.
    """
    if digits < 6:
        return f"(round({value}, {digits}) + CAST(0 AS DOUBLE))"
    return f"(round_even(({value}) * 1e{digits}, 0) / 1e{digits} + CAST(0 AS DOUBLE))"


def dbl(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


def with_(*blocks: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(blocks) + "\n"


_ORDER = "row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)"


def bars(grain: str = "month", where: str = "true", name: str = "bars") -> str:
    day = "CAST(l_shipdate AS DATE)"
    if grain == "month":
        day = "CAST(date_trunc('month', l_shipdate) AS DATE)"
    return f"""{name} AS (
  SELECT 'S' || l_suppkey AS ticker, {day} AS trade_date, CAST(0 AS INTEGER) AS session,
    arg_min(l_extendedprice, {_ORDER}) AS open,
    max(l_extendedprice) AS high, min(l_extendedprice) AS low,
    arg_max(l_extendedprice, {_ORDER}) AS close,
    sum(l_quantity) AS volume
  FROM lineitem WHERE {where} GROUP BY 1, 2)"""


TICKS = """ticks AS (
  SELECT 'U' || user_id AS ticker, ts, event_id, value AS price, CAST(1 AS BIGINT) AS volume
  FROM events)"""

_IN_SESSION = """(CAST(ts AS TIME) BETWEEN TIME '09:00:00' AND TIME '11:30:00'
    OR CAST(ts AS TIME) BETWEEN TIME '13:30:00' AND TIME '15:00:00')"""

SESSION_BARS = f"""session_bars AS (
  SELECT ticker, CAST(ts AS DATE) AS trade_date,
    CAST(CASE WHEN CAST(ts AS TIME) < TIME '13:30:00' THEN 1 ELSE 2 END AS INTEGER) AS session,
    arg_min(price, row(ts, event_id)) AS open, max(price) AS high, min(price) AS low,
    arg_max(price, row(ts, event_id)) AS close, CAST(sum(volume) AS BIGINT) AS volume
  FROM ticks WHERE {_IN_SESSION} GROUP BY 1, 2, 3)"""

IN_SESSION = _IN_SESSION

RAW_MARKED = """raw_marked AS (
  SELECT strftime(trade_date, '%Y-%m-%d') || CASE CAST(substr(ticker, 2) AS BIGINT) % 3
      WHEN 1 THEN '(1)' WHEN 2 THEN '(2)' ELSE '' END AS date,
    ticker, open, high, low, close, volume
  FROM bars)"""

RAW_MESSY = """raw_messy AS (
  SELECT CASE WHEN l_orderkey % 10 = 0 THEN 'n/a'
      WHEN l_orderkey % 10 < 3 THEN strftime(l_shipdate, '%Y-%m-%d') || '(1)'
      WHEN l_orderkey % 10 < 6 THEN strftime(l_shipdate, '%Y-%m-%d') || '(2)'
      WHEN l_orderkey % 10 < 8 THEN strftime(l_shipdate, '%Y-%m-%d') || ' 07:00:00'
      ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
    'S' || l_suppkey AS ticker, l_extendedprice AS open, l_extendedprice AS high,
    l_extendedprice AS low, l_extendedprice AS close,
    CASE WHEN l_partkey % 7 <> 0 THEN l_quantity END AS volume
  FROM lineitem)"""

CANONICAL = """canonical AS (
  SELECT CASE WHEN regexp_matches(date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
      THEN regexp_extract(date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') || CASE
        WHEN date LIKE '%(1)%' THEN '(1)' WHEN date LIKE '%(2)%' THEN '(2)' ELSE '' END
      END AS date, ticker, open, high, low, close, volume
  FROM raw_messy)"""

CLEAN = """cleaned AS (
  SELECT ticker, CAST(substr(date, 1, 10) AS DATE) AS trade_date,
    CAST(CASE WHEN date LIKE '%(1)' THEN 1 WHEN date LIKE '%(2)' THEN 2 ELSE 0 END
      AS INTEGER) AS session,
    open, high, low, close, volume
  FROM canonical WHERE date IS NOT NULL AND volume IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY ticker, date
    ORDER BY close DESC, volume DESC, high DESC, low DESC, open DESC) = 1)"""

_WINDOW = "PARTITION BY ticker ORDER BY trade_date, session"


def _frame(rows: int) -> str:
    return f"({_WINDOW} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def _change(now: str, then: str) -> str:
    return f"CASE WHEN {then} = 0 THEN 0.0 ELSE ({now} - {then}) / {then} END"


def _ratio(top: str, bottom: str, at_zero: str) -> str:
    return f"CASE WHEN {bottom} = 0 THEN {at_zero} ELSE {top} / {bottom} END"


def features(source: str = "bars") -> str:
    """``lagged``, ``first_pass``, ``feats`` (all rows) and ``kept`` (no NULLs)."""
    lags = ",\n    ".join(f"lag(close, {n}) OVER w AS prev_close_{n}" for n in (1, 3, 5, 10))
    returns = ",\n    ".join(
        f"{_change('close', f'prev_close_{n}')} AS return_{n}d" for n in (1, 3, 5, 10)
    )
    return_lags = ",\n    ".join(
        f"lag(return_1d, {n}) OVER w AS return_lag{n}" for n in (1, 2, 3)
    )
    present = " AND ".join(f"{name} IS NOT NULL" for name in FEATURES)
    return f"""lagged AS (
  SELECT *, {lags},
    lag(volume, 1) OVER w AS prev_volume_1, lead(close, 1) OVER w AS next_close,
    avg(close) OVER {_frame(5)} AS ma5, avg(close) OVER {_frame(10)} AS ma10,
    avg(volume) OVER {_frame(20)} AS avg_vol20
  FROM {source} WINDOW w AS ({_WINDOW})),
first_pass AS (
  SELECT *, {returns},
    {_ratio('close', 'ma5', '1.0')} AS price_vs_ma5,
    {_ratio('close', 'ma10', '1.0')} AS price_vs_ma10,
    {_ratio('ma5', 'ma10', '1.0')} AS ma5_vs_ma10,
    {_ratio('volume', 'avg_vol20', '1.0')} AS volume_ratio,
    {_change('volume', 'prev_volume_1')} AS volume_change,
    CASE WHEN open = 0 THEN 0.0 ELSE close / open - 1.0 END AS oc_return,
    {_ratio('(high - low)', 'close', '0.0')} AS hl_range,
    {_ratio('(close - low)', '(high - low)', '0.5')} AS close_position,
    CAST(CASE WHEN next_close > close THEN 1 WHEN next_close IS NOT NULL THEN 0 END
      AS INTEGER) AS target
  FROM lagged),
feats AS (
  SELECT *, stddev_samp(return_1d) OVER {_frame(5)} AS volatility_5,
    stddev_samp(return_1d) OVER {_frame(10)} AS volatility_10,
    {return_lags}
  FROM first_pass WINDOW w AS ({_WINDOW})),
kept AS MATERIALIZED (SELECT * FROM feats WHERE {present})"""


def scaled(fit: str = "kept") -> str:
    stats = ", ".join(
        f"avg({name}) AS {name}_mean, stddev_samp({name}) AS {name}_std" for name in FEATURES
    )
    values = ",\n    ".join(
        rounded(
            f"CASE WHEN {name}_std > 0 THEN ({name} - {name}_mean) / {name}_std ELSE 0.0 END", 6
        )
        + f" AS {name}_scaled"
        for name in FEATURES
    )
    return f"""stats AS (SELECT {stats} FROM {fit}),
scaled AS (
  SELECT strftime(trade_date, '%Y-%m-%d') || CASE session
      WHEN 1 THEN '(1)' WHEN 2 THEN '(2)' ELSE '' END AS date,
    trade_date, ticker, target,
    {values}, close
  FROM kept, stats)"""


SCALED_COLUMNS = ", ".join(f"{name}_scaled" for name in FEATURES)

CHAIN = [bars(), features(), scaled()]

LATEST = """latest AS (
  SELECT *, trade_date AS latest_data_date FROM scaled
  QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)"""


def probability(scorer_no: int, suffix: str = "_scaled") -> str:
    scorer = SCORERS[scorer_no]
    total = dbl(float(scorer.intercept))
    for name in FEATURES:
        if name in scorer.weights:
            total = f"({total} + {dbl(float(scorer.weights[name]))} * {name}{suffix})"
    return rounded(f"1.0 / (1.0 + exp(-({total})))", 9)


TIER = """CASE WHEN probability >= CAST(0.7 AS DOUBLE) OR probability <= CAST(0.3 AS DOUBLE)
    THEN 'HIGH' WHEN probability > CAST(0.6 AS DOUBLE) OR probability < CAST(0.4 AS DOUBLE)
    THEN 'MEDIUM' ELSE 'LOW' END"""

CALENDAR = f"""calendar AS (
  SELECT CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS day, d AS date FROM (
    SELECT CAST(g AS DATE) AS d FROM generate_series(
      TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY, TIMESTAMP '{AS_OF}' + INTERVAL 34 DAY,
      INTERVAL 1 DAY) AS s(g))
  WHERE isodow(d) < 6)"""

# What one forecast day does to the features; s is +1 or -1.
_SET = {"return_1d": 0.8, "oc_return": 0.5, "close_position": 0.8}
_SHRINK = {"return_3d": 0.4, "return_5d": 0.3, "return_10d": 0.2}
_ADD = {"price_vs_ma5": 0.15, "price_vs_ma10": 0.1, "ma5_vs_ma10": 0.05}
_SHIFT = {"return_lag1": "return_1d", "return_lag2": "return_lag1", "return_lag3": "return_lag2"}


def rolled(name: str, suffix: str = "_scaled") -> str:
    column = f"{name}{suffix}"
    if name in _SET:
        return f"s * {dbl(_SET[name])}"
    if name in _SHRINK:
        return f"{column} * {dbl(0.8)} + s * {dbl(_SHRINK[name])}"
    if name in _ADD:
        return f"{column} + s * {dbl(_ADD[name])}"
    return f"{_SHIFT.get(name, name)}{suffix}"


def forecast(floor: float | None = None) -> str:
    """``long``: one row per ticker and forecast day."""
    high = f"({dbl(0.7)} - CAST(day - 1 AS DOUBLE) * {dbl(0.02)})"
    if floor is not None:
        high = f"greatest({high}, {dbl(floor)})"
    weight = f"greatest({dbl(0.3)}, {dbl(1.0)} - CAST(day - 1 AS DOUBLE) * {dbl(0.05)})"
    state = ", ".join(f"{name}_scaled" for name in FEATURES)
    step = ", ".join(f"{rolled(name)} AS {name}_scaled" for name in FEATURES)
    return f"""{CALENDAR},
roll AS (
  SELECT ticker, latest_data_date, CAST(1 AS INTEGER) AS day, {state},
    {probability(0)} AS p FROM latest
  UNION ALL
  SELECT ticker, latest_data_date, day, {state}, {probability(0)} AS p FROM (
    SELECT ticker, latest_data_date, CAST(day + 1 AS INTEGER) AS day, {step} FROM (
      SELECT *, CAST(CASE WHEN p > CAST(0.5 AS DOUBLE) THEN 1 ELSE -1 END AS DOUBLE) AS s
      FROM roll WHERE day < {HORIZON}))),
damped AS (
  SELECT ticker, latest_data_date, day,
    CAST(CASE WHEN p > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS INTEGER) AS prediction,
    p * k + CAST(0.5 AS DOUBLE) * (CAST(1.0 AS DOUBLE) - k) AS probability,
    {high} AS high
  FROM (SELECT *, {weight} AS k FROM roll)),
long AS (
  SELECT ticker, latest_data_date, day, date, prediction,
    CASE WHEN prediction = 1 THEN 'UP' ELSE 'DOWN' END AS signal, probability,
    CASE WHEN probability >= high OR probability <= CAST(1.0 AS DOUBLE) - high THEN 'HIGH'
      WHEN probability > CAST(0.6 AS DOUBLE) OR probability < CAST(0.4 AS DOUBLE) THEN 'MEDIUM'
      ELSE 'LOW' END AS confidence
  FROM damped JOIN calendar USING (day))"""


_WIDE_COLUMNS = ",\n    ".join(
    f"max(CASE WHEN day = {day} THEN {field} END) AS day_{day}_{field}"
    for day in range(1, HORIZON + 1)
    for field in DAY_FIELDS
)
WIDE = f"""wide AS (
  SELECT ticker, latest_data_date, {_WIDE_COLUMNS} FROM long GROUP BY 1, 2)"""

FORECAST_CHAIN = [*CHAIN, LATEST, forecast()]
WIDE_CHAIN = [*FORECAST_CHAIN, WIDE]

SLICE = """slice AS (
  SELECT * FROM wide WHERE latest_data_date = (SELECT max(latest_data_date) FROM wide))"""

INFO = """info AS (
  SELECT ticker, close, volume FROM bars
  QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC, session DESC) = 1)"""

NEXT_DAY = """CAST({0} + CASE isodow({0}) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE)"""

HISTORY = f"""history AS (
  SELECT last_day(trade_date) AS prediction_date, ticker, trade_date AS latest_data_date,
    {NEXT_DAY.format('last_day(trade_date)')} AS predicted_for_date,
    CAST(CASE WHEN probability > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS INTEGER) AS prediction,
    CASE WHEN probability > CAST(0.5 AS DOUBLE) THEN 'UP' ELSE 'DOWN' END AS signal,
    probability, {TIER} AS confidence
  FROM (SELECT *, {probability(0)} AS probability FROM scaled)),
newest AS (
  SELECT * FROM history
  WHERE predicted_for_date = (SELECT max(predicted_for_date) FROM history))"""
HISTORY_CHAIN = [*CHAIN, HISTORY]

SPLIT = """daily AS (
  SELECT trade_date, count(*) AS n FROM scaled WHERE target IS NOT NULL GROUP BY 1),
cutoff AS (
  SELECT min(trade_date) AS cut FROM (
    SELECT trade_date, sum(n) OVER (ORDER BY trade_date) AS upto, sum(n) OVER () AS total
    FROM daily) WHERE upto > floor(total * CAST(0.8 AS DOUBLE))),
folds AS (
  SELECT *, CASE WHEN trade_date < cut THEN 'train' ELSE 'test' END AS fold
  FROM scaled, cutoff WHERE target IS NOT NULL)"""

SCORED_TEST = f"""scored AS (
  SELECT *, CAST(CASE WHEN probability > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS INTEGER)
    AS prediction
  FROM (SELECT *, {probability(0)} AS probability FROM folds WHERE fold = 'test'))"""

ALL_SCORES = "scored AS (\n" + "\n  UNION ALL\n".join(
    f"""  SELECT '{scorer.name}' AS model, substr(date, 1, 4) AS year, target, probability,
    CASE WHEN probability > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS prediction
  FROM (SELECT *, {probability(number)} AS probability FROM scaled WHERE target IS NOT NULL)"""
    for number, scorer in enumerate(SCORERS)
) + ")"

ACCURACY = "avg(CASE WHEN prediction = target THEN 1.0 ELSE 0.0 END)"
F1 = """coalesce(2.0 * count(*) FILTER (prediction = 1 AND target = 1)
    / nullif(count(*) FILTER (prediction = 1) + count(*) FILTER (target = 1), 0), 0.0)"""


def auc(keys: str = "") -> str:
    """``areas``: AUC per key from the rank form, one row per distinct score first."""
    lead = f"{keys}, " if keys else ""
    partition = f"PARTITION BY {keys} " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""by_score AS (
  SELECT {lead}probability, count(*) FILTER (target = 1) AS up,
    count(*) FILTER (target = 0) AS down
  FROM scored GROUP BY {lead}probability),
areas AS (
  SELECT {lead}CAST(sum(up * (below + down / 2.0)) AS DOUBLE)
      / nullif(CAST(sum(up) AS DOUBLE) * CAST(sum(down) AS DOUBLE), 0) AS auc
  FROM (SELECT *, coalesce(sum(down) OVER ({partition}ORDER BY probability
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM by_score) {group})"""


RUNS = f"""{auc('model, year')},
runs AS (
  SELECT m.model || '-' || m.year AS run_id, m.model AS model,
    {rounded('accuracy', 9)} AS accuracy, {rounded('f1', 9)} AS f1,
    {rounded('auc', 9)} AS auc, CAST(m.year || '-12-31' AS DATE) AS saved_at
  FROM (SELECT model, year, {ACCURACY} AS accuracy, {F1} AS f1 FROM scored GROUP BY 1, 2) m
  JOIN areas USING (model, year))"""
RUNS_CHAIN = [*CHAIN, ALL_SCORES, RUNS]
