"""Newest row per ticker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import dates


def newest_per_ticker(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The last row of each ticker in ``order``.

    A row number with a limit of one: Spark keeps one row per ticker in every
    task before the shuffle, so a busy ticker costs no more than a quiet one.
    """
    w = W.partitionBy("ticker").orderBy(*(F.col(name).desc() for name in order))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def latest_price_volume(bars: DataFrame) -> DataFrame:
    order = ["date"] if "date" in bars.columns else ["trade_date", "session"]
    return newest_per_ticker(bars, order).select("ticker", "close", "volume", *order)


def stock_info(bars: DataFrame) -> DataFrame:
    return latest_price_volume(bars).select("ticker", "close", "volume")


def latest_features(table: DataFrame) -> DataFrame:
    """Newest feature row per ticker; the text key sorts as (date, session).

    The rows come in even parts, one for each core: they are few bytes, but trees take milliseconds a row to roll them.
    """
    newest = newest_per_ticker(table, ["date"])
    return newest.repartition(table.sparkSession.sparkContext.defaultParallelism).withColumn(
        "latest_data_date", dates.date_part_of(F.col("date"))
    )


def latest_dates(latest: DataFrame) -> DataFrame:
    """Newest date overall and the number of tickers in the latest slice."""
    return latest.agg(
        F.max("latest_data_date").alias("latest_date"),
        F.count_distinct("ticker").alias("tickers"),
    )
