"""Questions answered from the published stock and forecast tables.

``wide`` is the published forecast with five columns per day. Every question
reads only the days it needs and is a filter with a top-k, or one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import tiers
from tidemark.operators import forecast

_DAY_1 = ("prediction", "signal", "probability", "confidence")


def stock_list(info: DataFrame, limit: int = 50) -> DataFrame:
    return info.select("ticker", "close", "volume").orderBy("ticker").limit(limit)


def stock_search(info: DataFrame, text: str, limit: int = 50) -> DataFrame:
    """Tickers containing ``text`` in any case; ``%`` and ``_`` in it are wildcards."""
    found = info.filter(F.col("ticker").ilike(f"%{text}%"))
    return stock_list(found, limit)


def _sort_order(sort_by: str, order: str) -> list[Column]:
    columns = {"price": "close", "volume": "volume"}
    if sort_by not in columns:
        raise ValueError(f"sort_by must be 'price' or 'volume': {sort_by!r}")
    if order not in ("asc", "desc"):
        raise ValueError(f"order must be 'asc' or 'desc': {order!r}")
    column = F.col(columns[sort_by])
    return [column.desc() if order == "desc" else column.asc(), F.col("ticker").asc()]


def stock_page(
    info: DataFrame, sort_by: str, order: str = "desc", limit: int = 10, offset: int = 0
) -> DataFrame:
    """One page of the sorted listing."""
    page = info.select("ticker", "close", "volume").orderBy(*_sort_order(sort_by, order))
    return (page.offset(offset) if offset else page).limit(limit)


def stock_count(info: DataFrame) -> DataFrame:
    return info.agg(F.count("*").alias("total"))


def sorted_then_search(
    info: DataFrame, sort_by: str, order: str, text: str, first: int = 100, show: int = 50
) -> DataFrame:
    """Search inside the first rows of the sorted listing, not the whole table."""
    top = stock_page(info, sort_by, order, first)
    wanted = text.strip().upper()
    if wanted:
        top = top.filter(F.upper("ticker").contains(wanted))
    return top.orderBy(*_sort_order(sort_by, order)).limit(show)


def as_of_global(wide: DataFrame) -> DataFrame:
    """Rows whose data is as new as the newest in the table."""
    newest = wide.agg(F.max("latest_data_date")).scalar()
    return wide.filter(F.col("latest_data_date") == newest)


def as_of_ticker(wide: DataFrame, ticker: str) -> DataFrame:
    """The newest row of one ticker, however old it is."""
    return (
        wide.filter(F.col("ticker") == ticker.upper())
        .orderBy(F.desc("latest_data_date"))
        .limit(1)
    )


def sync_status(wide: DataFrame) -> DataFrame:
    return wide.agg(
        F.max("latest_data_date").alias("latest_data_date"),
        F.count_distinct("ticker").alias("total_predicted_tickers"),
    ).withColumn(
        "status",
        F.when(F.col("latest_data_date").isNull(), "UNHEALTHY").otherwise("HEALTHY"),
    )


def recommendations(wide: DataFrame, limit: int = 5, days: int = 3) -> DataFrame:
    """Tickers predicted up on each of the first days, by mean probability."""
    rows = as_of_global(wide)
    total = F.lit(0.0)
    for day in range(1, days + 1):
        rows = rows.filter(F.col(f"day_{day}_prediction") == 1)
        total = total + F.col(f"day_{day}_probability")
    return (
        rows.select("ticker", F.round(total / days, 3).alias("average_probability"))
        .orderBy(F.desc("average_probability"), "ticker")
        .limit(limit)
    )


def _day_1(rows: DataFrame) -> DataFrame:
    return rows.select(
        "ticker",
        "latest_data_date",
        F.col("day_1_date").alias("next_date"),
        *(F.col(f"day_1_{field}").alias(field) for field in _DAY_1),
    )


def watchlist(tickers: str) -> list[str]:
    """Names of a comma-separated list, trimmed and in upper case."""
    return [name.strip().upper() for name in tickers.split(",")]


def next_batch(wide: DataFrame, tickers: str | DataFrame | None = None) -> DataFrame:
    """Day-1 forecasts of the latest slice, of all tickers or of a watch list.

    Text is for lists a person types; a long list comes as a table with ``ticker``.
    """
    rows = as_of_global(wide)
    if isinstance(tickers, DataFrame):
        names = tickers.select(F.upper(F.trim("ticker")).alias("ticker"))
        rows = rows.join(names, "ticker", "left_semi")
    elif tickers:
        rows = rows.filter(F.col("ticker").isin(*watchlist(tickers)))
    return _day_1(rows)


def _ranked(
    wide: DataFrame, prediction: int, order: Column, limit: int, minimum: str
) -> DataFrame:
    if not 1 <= limit <= 100:
        raise ValueError(f"limit must lie between 1 and 100: {limit}")
    rows = as_of_global(wide).filter(
        (F.col("day_1_prediction") == prediction)
        & tiers.at_least(F.col("day_1_confidence"), minimum)
    )
    return (
        rows.orderBy(order, F.col("ticker").asc())
        .limit(limit)
        .select(
            "ticker",
            F.col("day_1_date").alias("next_date"),
            F.col("day_1_signal").alias("signal"),
            F.col("day_1_probability").alias("probability"),
            F.col("day_1_confidence").alias("confidence"),
        )
    )


def top_buy(wide: DataFrame, limit: int = 10, min_confidence: str = "MEDIUM") -> DataFrame:
    return _ranked(wide, 1, F.col("day_1_probability").desc(), limit, min_confidence)


def top_sell(wide: DataFrame, limit: int = 10, min_confidence: str = "MEDIUM") -> DataFrame:
    return _ranked(wide, 0, F.col("day_1_probability").asc(), limit, min_confidence)


def min_tier_set(wide: DataFrame, minimum: str) -> DataFrame:
    """Day-1 forecasts of tier ``minimum`` or stronger, with the tier's rank."""
    kept = _day_1(as_of_global(wide)).filter(tiers.at_least(F.col("confidence"), minimum))
    return kept.select("ticker", "confidence", tiers.tier_rank(F.col("confidence")).alias("rank"))


def next_single(wide: DataFrame, ticker: str) -> DataFrame:
    return _day_1(as_of_ticker(wide, ticker))


def forecast_single(wide: DataFrame, ticker: str) -> DataFrame:
    return forecast.unpivot(as_of_ticker(wide, ticker))


def market_summary(wide: DataFrame) -> DataFrame:
    """Breadth, tiers, mean probability and sentiment of the next session."""

    def rows(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    tier = F.col("day_1_confidence")
    counts = as_of_global(wide).agg(
        F.count("*").alias("total_tickers"),
        F.max("day_1_date").alias("next_session_date"),
        rows(F.col("day_1_prediction") == 1, "up_count"),
        rows(F.col("day_1_prediction") == 0, "down_count"),
        rows(tier == "HIGH", "high_count"),
        rows(tier == "MEDIUM", "medium_count"),
        rows(tier == "LOW", "low_count"),
        F.round(F.coalesce(F.avg("day_1_probability"), F.lit(0.0)), 4).alias("avg_probability"),
    )
    share = F.col("up_count") / F.col("total_tickers") * 100.0
    percent = F.round(F.when(F.col("total_tickers") > 0, share).otherwise(0.0), 2)
    return (
        counts.withColumn("up_percent", percent)
        .withColumn("down_percent", F.round(F.lit(100.0) - F.col("up_percent"), 2))
        .withColumn("market_sentiment", tiers.DASHBOARD.of(F.col("up_percent")))
    )


def forecast_day_counts(long: DataFrame) -> DataFrame:
    """Rising, falling and high-confidence days per ticker."""

    def days(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    return long.groupBy("ticker").agg(
        days(F.col("prediction") == 1, "up_days"),
        days(F.col("prediction") == 0, "down_days"),
        days(F.col("confidence") == "HIGH", "high_days"),
    )


def forecast_series(long: DataFrame, tickers: Sequence[str] | None = None) -> DataFrame:
    """Chart points: day label, date and probability in percent."""
    rows = long if tickers is None else long.filter(F.col("ticker").isin(*tickers))
    return rows.select(
        "ticker",
        F.concat(F.lit("D"), F.col("day").cast("string")).alias("day"),
        "date",
        F.round(F.col("probability") * 100.0, 2).alias("probability"),
        "prediction",
        "signal",
        "confidence",
    )
