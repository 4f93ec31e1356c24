"""The fifteen-day roll-forward and its long, wide and text forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, scoring, tiers
from tidemark.operators import models
from tidemark.schemas import DAY_FIELDS, FEATURES, FORECAST_LONG, HORIZON, SCALED

# How a predicted move changes the scaled features of the next day.
SET_TO = {"return_1d": 0.8, "oc_return": 0.5, "close_position": 0.8}
SHRINK = 0.8
SHRINK_AND_ADD = {"return_3d": 0.4, "return_5d": 0.3, "return_10d": 0.2}
ADD = {"price_vs_ma5": 0.15, "price_vs_ma10": 0.10, "ma5_vs_ma10": 0.05}
SHIFT = {"return_lag1": "return_1d", "return_lag2": "return_lag1", "return_lag3": "return_lag2"}


def next_state(value: Callable[[str], Column], prediction: Column) -> dict[str, Column]:
    """Scaled features of the following day, given today's and the predicted class."""
    direction = F.when(prediction == 1, 1.0).otherwise(-1.0)
    state: dict[str, Column] = {}
    for name in FEATURES:
        if name in SET_TO:
            state[name] = direction * F.lit(SET_TO[name])
        elif name in SHRINK_AND_ADD:
            state[name] = value(name) * F.lit(SHRINK) + direction * F.lit(SHRINK_AND_ADD[name])
        elif name in ADD:
            state[name] = value(name) + direction * F.lit(ADD[name])
        else:
            state[name] = value(SHIFT.get(name, name))
    return state


def rollforward_step(scored: DataFrame) -> DataFrame:
    """Replace the scaled features by those of the next day."""
    state = next_state(lambda name: F.col(f"{name}_scaled"), F.col("prediction"))
    return scored.withColumns({f"{name}_scaled": value for name, value in state.items()})


def _day_entry(day: Column, p: Column, prediction: Column, floor: float | None) -> Column:
    shown = tiers.damped(p, day)
    return F.struct(
        day.alias("day"),
        prediction.alias("prediction"),
        shown.alias("probability"),
        tiers.horizon_tier(shown, day, floor).alias("confidence"),
    )


_ENTRIES = "array<struct<day:int,prediction:int,probability:double,confidence:string>>"


def _folded_entries(
    scorer: scoring.Scorer, latest: DataFrame, days: int, floor: float | None
) -> DataFrame:
    """All days in one projection: the state folds over 1..days inside the row."""
    start = F.struct(
        *(F.col(f"{name}_scaled").cast("double").alias(name) for name in FEATURES),
        F.array().cast(_ENTRIES).alias("entries"),
    )

    def step(state: Column, day: Column) -> Column:
        def after(p: Column) -> Column:
            prediction = scoring.hard_class(p)
            entry = _day_entry(day, p, prediction, floor)
            following = next_state(lambda name: state[name], prediction)
            return F.struct(
                *(following[name].alias(name) for name in FEATURES),
                F.concat(state["entries"], F.array(entry)).cast(_ENTRIES).alias("entries"),
            )

        # A bound variable, so that the scorer runs once a day.
        return F.transform(F.array(scorer.probability(lambda name: state[name])), after)[0]

    folded = F.aggregate(F.sequence(F.lit(1), F.lit(days)), start, step)
    return latest.select("ticker", "latest_data_date", folded["entries"].alias("entries"))


def _model_entries(
    model: Model, latest: DataFrame, days: int, floor: float | None
) -> DataFrame:
    """One model call per day on one row per ticker, for models that are no column expression."""
    state = latest.select("ticker", "latest_data_date", *SCALED).withColumn(
        "entries", F.array().cast(_ENTRIES)
    )
    for day in range(1, days + 1):
        scored = models.score(model, state)
        entry = _day_entry(F.lit(day), F.col("probability"), F.col("prediction"), floor)
        state = rollforward_step(
            scored.withColumn("entries", F.concat("entries", F.array(entry)).cast(_ENTRIES))
        ).select("ticker", "latest_data_date", *SCALED, "entries")
    return state.select("ticker", "latest_data_date", "entries")


def forecast(
    model: Model | scoring.Scorer,
    latest: DataFrame,
    as_of: str,
    days: int = HORIZON,
    tier_floor: float | None = None,
) -> DataFrame:
    """One row per ticker with ``entries``, an array of one struct per trading day.

    The class comes from the model's own probability; the stored probability is
    pulled towards one half with the day. Each row rolls by itself, where ``latest_features`` has put it.
    """
    build = _folded_entries if isinstance(model, scoring.Scorer) else _model_entries
    calendar = dates.trading_days(F.lit(as_of).cast("date"), days)

    def dated(entry: Column) -> Column:
        return F.struct(
            entry["day"].alias("day"),
            F.element_at(calendar, entry["day"]).alias("date"),
            entry["prediction"].alias("prediction"),
            tiers.signal(entry["prediction"]).alias("signal"),
            entry["probability"].alias("probability"),
            entry["confidence"].alias("confidence"),
        )

    rolled = build(model, latest, days, tier_floor)
    return rolled.withColumn("entries", F.transform("entries", dated))


def to_long(entries: DataFrame) -> DataFrame:
    """One row per forecast day; every ticker has entries.

    The outer form keeps the optimizer from testing the array for emptiness first,
    which would roll the forecast a second time.
    """
    return entries.select(
        "ticker", "latest_data_date", F.explode_outer("entries").alias("e")
    ).select("ticker", "latest_data_date", "e.*").select(*FORECAST_LONG.fieldNames())


def to_wide(entries: DataFrame, days: int = HORIZON) -> DataFrame:
    """Five columns per day, straight from the array; no shuffle."""
    return entries.select(
        "ticker",
        "latest_data_date",
        *(
            F.col("entries")[day - 1][field].alias(f"day_{day}_{field}")
            for day in range(1, days + 1)
            for field in DAY_FIELDS
        ),
    )


def pivot_wide(long: DataFrame, days: int = HORIZON) -> DataFrame:
    """The wide layout from a stored long table."""
    pivoted = (
        long.groupBy("ticker", "latest_data_date")
        .pivot("day", list(range(1, days + 1)))
        .agg(*(F.first(field).alias(field) for field in DAY_FIELDS))
    )
    return pivoted.select(
        "ticker",
        "latest_data_date",
        *(
            F.col(f"{day}_{field}").alias(f"day_{day}_{field}")
            for day in range(1, days + 1)
            for field in DAY_FIELDS
        ),
    )


def unpivot(wide: DataFrame, days: int = HORIZON) -> DataFrame:
    """Wide rows as one row per day, days without a date left out; no shuffle."""
    entries = F.array(
        *(
            F.struct(
                F.lit(day).alias("day"),
                *(F.col(f"day_{day}_{field}").alias(field) for field in DAY_FIELDS),
            )
            for day in range(1, days + 1)
        )
    )
    return to_long(wide.select("ticker", "latest_data_date", entries.alias("entries"))).filter(
        F.col("date").isNotNull()
    )


def csv_view(wide: DataFrame, days: int = HORIZON) -> DataFrame:
    """Columns and percent text of the exported forecast file."""
    columns = [F.col("ticker").alias("Ticker"), F.col("latest_data_date").alias("Latest_Data")]
    for day in range(1, days + 1):
        percent = F.col(f"day_{day}_probability") * 100
        columns += [
            F.col(f"day_{day}_date").alias(f"Day{day}_Date"),
            F.col(f"day_{day}_signal").alias(f"Day{day}_Signal"),
            F.format_string("%.1f%%", percent).alias(f"Day{day}_Confidence"),
            F.col(f"day_{day}_confidence").alias(f"Day{day}_Level"),
        ]
    return wide.select(*columns)
