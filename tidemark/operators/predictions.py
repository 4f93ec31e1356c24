"""Questions about the next-session predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(history: DataFrame) -> DataFrame:
    """The newest day's predictions; the day is found first and prunes partitions."""
    newest = history.agg(F.max("predicted_for_date")).scalar()
    return history.filter(F.col("predicted_for_date") == newest)


def for_ticker(preds: DataFrame, ticker: str) -> DataFrame:
    return preds.filter(F.col("ticker") == ticker)


def by_signal(preds: DataFrame, prediction: int) -> DataFrame:
    return preds.filter(F.col("prediction") == prediction).orderBy(
        F.desc("probability"), "ticker"
    )


def high_confidence(preds: DataFrame) -> DataFrame:
    return preds.filter(F.col("confidence") == "HIGH").orderBy(
        F.desc("probability"), "ticker"
    )


def history(
    preds: DataFrame, as_of: str, days: int = 30, ticker: str | None = None
) -> DataFrame:
    """Predictions made in the last ``days`` days, newest first.

    A prediction is always for a later day than the one it was made on, so the filter
    on the target date loses no row and prunes the folders.
    """
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    target = F.col("predicted_for_date")
    kept = preds.filter((F.col("prediction_date") >= since) & ((target >= since) | target.isNull()))
    if ticker is not None:
        kept = kept.filter(F.col("ticker") == ticker)
    return kept.orderBy(F.desc("prediction_date"), "ticker")


def _percent(count: str) -> Column:
    share = F.col(count) / F.col("total") * 100.0
    return F.round(F.when(F.col("total") > 0, share).otherwise(0.0), 1)


def summary(preds: DataFrame) -> DataFrame:
    """Counts and percentages by class and tier, in one pass."""

    def rows(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    counts = preds.agg(
        F.max("prediction_date").alias("prediction_date"),
        F.max("predicted_for_date").alias("predicted_for_date"),
        F.count("*").alias("total"),
        rows(F.col("prediction") == 1, "up"),
        rows(F.col("prediction") == 0, "down"),
        *(rows(F.col("confidence") == tier, tier.lower()) for tier in ("HIGH", "MEDIUM", "LOW")),
    )
    return counts.withColumns(
        {f"{name}_percent": _percent(name) for name in ("up", "down", "high", "medium", "low")}
    )


def top_up(preds: DataFrame, limit: int = 10, only_high: bool = False) -> DataFrame:
    rows = preds.filter(F.col("prediction") == 1)
    if only_high:
        rows = rows.filter(F.col("confidence") == "HIGH")
    return (
        rows.orderBy(F.desc("probability"), "ticker")
        .limit(limit)
        .select("ticker", "probability", "confidence")
    )


def top_down(preds: DataFrame, limit: int = 10) -> DataFrame:
    """The likeliest falls, shown as the probability of falling."""
    return (
        preds.filter(F.col("prediction") == 0)
        .orderBy("probability", "ticker")
        .limit(limit)
        .select("ticker", (F.lit(1.0) - F.col("probability")).alias("probability"), "confidence")
    )
