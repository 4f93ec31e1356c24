"""Cleaning of raw bars: canonical dates, nulls, duplicates, row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.schemas import PRICES


def canonical_dates(raw: DataFrame) -> DataFrame:
    """Rewrite ``date`` as ``YYYY-MM-DD`` plus marker; NULL where no date is found."""
    return raw.withColumn("date", dates.canonical_key(F.col("date")))


def quarantine(raw: DataFrame) -> DataFrame:
    """Rows whose date text holds no calendar date."""
    return raw.filter(F.col("date").isNull() | dates.date_part_of(F.col("date")).isNull())


def with_plain_date(raw: DataFrame) -> DataFrame:
    """Add ``trade_date``: the date text without its marker, in any known format."""
    return raw.withColumn("trade_date", dates.strip_marker(F.col("date")))


def drop_nulls(df: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct; aggregated before the shuffle."""
    return df.dropDuplicates()


def one_per_session(bars: DataFrame) -> DataFrame:
    """Keep one row per key: the largest (close, volume, high, low, open).

    Conflicting rows would leave the bar order undefined. The row limit runs on
    both sides of the shuffle, so a repeated key never gathers in one task.
    """
    order = [F.col(name).desc() for name in ("close", "volume", "high", "low", "open")]
    w = W.partitionBy("ticker", "trade_date", "session").orderBy(*order)
    return bars.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def typed(raw: DataFrame) -> DataFrame:
    """Raw text-dated rows as typed bars."""
    key = F.col("date")
    return raw.select(
        "ticker",
        dates.date_part_of(key).alias("trade_date"),
        dates.session_part_of(key).alias("session"),
        *PRICES,
        F.col("volume").cast("double").alias("volume"),
    )


def clean(raw: DataFrame) -> DataFrame:
    """Typed bars without nulls, one row per (ticker, date, session).

    The result is unique per (ticker, trade_date, session), so a ticker holds at
    most three bars per calendar day however often its rows were repeated.
    """
    # The date text is parsed once, into the typed key; one row per key makes a
    # separate whole-row distinct redundant.
    return one_per_session(drop_nulls(typed(raw)))


def collapse_sessions(bars: DataFrame) -> DataFrame:
    """One bar per day: the whole-day bar where there is one, else both sessions merged."""
    whole = F.col("session") == 0

    def pick(day_value: Column, merged: Column) -> Column:
        return F.coalesce(F.max(F.when(whole, day_value)), merged)

    part = F.when(~whole, F.col("session"))
    return bars.groupBy("ticker", "trade_date").agg(
        F.lit(0).alias("session"),
        pick(F.col("open"), F.min_by("open", part)).alias("open"),
        pick(F.col("high"), F.max("high")).alias("high"),
        pick(F.col("low"), F.min("low")).alias("low"),
        pick(F.col("close"), F.max_by("close", part)).alias("close"),
        pick(F.col("volume"), F.sum("volume")).alias("volume"),
    )


def profile(raw: DataFrame) -> DataFrame:
    """Row counts before and after each cleaning step in one aggregate.

    Identical rows are counted first, so the wide rows shuffle once, already
    combined, and every figure follows from the counted groups.
    """
    width = len(raw.columns)
    canonical = canonical_dates(raw)
    whole = None
    for name in canonical.columns:
        present = F.col(name).isNotNull()
        whole = present if whole is None else whole & present
    groups = canonical.groupBy(*canonical.columns).agg(F.count("*").alias("copies"))
    return groups.agg(
        F.sum("copies").alias("rows"),
        F.count_distinct("ticker").alias("tickers"),
        F.lit(width).alias("columns"),
        F.sum(F.when(whole, F.col("copies")).otherwise(0)).alias("rows_without_nulls"),
        F.sum(F.when(whole, 1).otherwise(0)).cast("bigint").alias("rows_distinct"),
    ).withColumn(
        "removed_nulls", F.col("rows") - F.col("rows_without_nulls")
    ).withColumn(
        "removed_duplicates", F.col("rows_without_nulls") - F.col("rows_distinct")
    )


def sample_keys(raw: DataFrame, count: int = 5) -> DataFrame:
    """The first few distinct canonical date keys."""
    return canonical_dates(raw).select("date").distinct().orderBy("date").limit(count)
