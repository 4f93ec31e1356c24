"""The library's input tables, derived by Spark from the supplied test tables.

There is no price table among them: order lines stand in for trades of a ticker
named after the supplier, and events for ticks of a ticker named after the user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scoring
from tidemark.operators.ingest import ohlcv

# A total order of the trades of one ticker and period.
_TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "price", "volume")

# The scorers used wherever results must be reproducible by hand.
# Probabilities are compared with SQL to this many digits.
_DIGITS = 9


def _scorer(name: str, intercept: float, weights: dict[str, float]) -> scoring.LinearScorer:
    return scoring.LinearScorer(name, intercept, weights, _DIGITS)


SCORERS = (
    _scorer(
        "blend",
        0.05,
        {
            "return_1d": 0.35,
            "return_3d": -0.25,
            "return_5d": 0.30,
            "return_10d": -0.20,
            "price_vs_ma5": 0.40,
            "price_vs_ma10": -0.15,
            "ma5_vs_ma10": 0.25,
            "volume_ratio": 0.10,
            "volume_change": -0.05,
            "volatility_5": -0.30,
            "volatility_10": 0.20,
            "oc_return": 0.45,
            "hl_range": -0.10,
            "close_position": 0.35,
            "return_lag1": -0.20,
            "return_lag2": 0.15,
            "return_lag3": -0.10,
        },
    ),
    _scorer(
        "momentum", 0.0, {"return_3d": 0.6, "return_5d": 0.4, "return_10d": 0.3}
    ),
    _scorer(
        "reversal", 0.0, {"close_position": -0.8, "price_vs_ma5": -0.5, "return_1d": -0.3}
    ),
    _scorer(
        "volume", -0.1, {"volume_ratio": 0.7, "volume_change": 0.2, "volatility_5": -0.2}
    ),
)
BLEND = SCORERS[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ticker() -> Column:
    return F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _ticker(),
        F.to_date("l_shipdate").alias("trade_date"),
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("volume"),
        "l_linestatus",
    )


def bars(
    spark: SparkSession, sf_dir: str, grain: str = "month", status: str | None = None
) -> DataFrame:
    """Monthly or daily bars.

    The narrow lines are shuffled by supplier and period and then sorted once: a line combined in a task
    would carry its order key twice, and few lines of a period meet in a task. Sorting whole input
    splits for that spills. What gathers in a task is one period of a ticker, not its history.
    """
    rows = trades(spark, sf_dir)
    if status is not None:
        rows = rows.filter(F.col("l_linestatus") == status)
    if grain == "month":
        rows = rows.withColumn("trade_date", F.trunc("trade_date", "month"))
    keys = ("l_suppkey", "trade_date")
    return (
        rows.select(*keys, *_TRADE_ORDER)
        .repartition(*keys)
        .groupBy(*keys)
        .agg(*ohlcv(_TRADE_ORDER))
        .select(
            _ticker(),
            "trade_date",
            F.lit(0).alias("session"),
            "open",
            "high",
            "low",
            "close",
            "volume",
        )
    )


def raw_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars with text dates: plain, ``(1)`` or ``(2)`` by supplier number."""
    daily = bars(spark, sf_dir, "day")
    session = F.substring("ticker", 2, 20).cast("bigint") % 3
    day = F.col("trade_date").cast("string")
    mark = F.when(session == 1, "(1)").when(session == 2, "(2)").otherwise("")
    return daily.select(
        F.concat(day, mark).alias("date"), "ticker", "open", "high", "low", "close", "volume"
    )


def raw_messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as uncleaned rows: mixed date texts, missing values, repeats.

    Lines of one supplier and day repeat a key with other values; a plain date
    may carry a time, some have no date at all and some no volume.
    """
    rows = trades(spark, sf_dir)
    day = F.col("trade_date").cast("string")
    kind = F.col("l_orderkey") % 10
    text = (
        F.when(kind == 0, "n/a")
        .when(kind < 3, F.concat(day, F.lit("(1)")))
        .when(kind < 6, F.concat(day, F.lit("(2)")))
        .when(kind < 8, F.concat(day, F.lit(" 07:00:00")))
        .otherwise(day)
    )
    price = F.col("price")
    return rows.select(
        text.alias("date"),
        "ticker",
        price.alias("open"),
        price.alias("high"),
        price.alias("low"),
        price.alias("close"),
        F.when(F.col("l_partkey") % 7 != 0, F.col("volume")).alias("volume"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        "ts",
        "event_id",
        F.col("value").alias("price"),
        F.lit(1).cast("bigint").alias("volume"),
    )


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") > 5000)
        .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"))
    )


def customers_as_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A longer list of tickers, most of them without bars."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("ticker")
    )
