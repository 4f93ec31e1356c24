"""The tables of the daily report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import dates, tiers
from tidemark.operators import forecast


def _rows(condition: Column, name: str) -> Column:
    return F.count(F.when(condition, 1)).alias(name)


def day1_breadth(wide: DataFrame) -> DataFrame:
    """Rising and falling tickers on day 1 and the report's market label."""
    counts = wide.agg(
        F.max("day_1_date").alias("date"),
        F.count("*").alias("total"),
        _rows(F.col("day_1_prediction") == 1, "up"),
        _rows(F.col("day_1_prediction") == 0, "down"),
    )
    percent = F.when(F.col("total") > 0, F.col("up") / F.col("total") * 100.0)
    return (
        counts.withColumn("up_percent", percent)
        .withColumn("down_percent", F.lit(100.0) - F.col("up_percent"))
        .withColumn(
            "sentiment",
            F.when(F.col("total") > 0, tiers.REPORT.of(F.col("up_percent"))).otherwise("UNKNOWN"),
        )
    )


def day1_top(wide: DataFrame, count: int = 5) -> DataFrame:
    """The strongest rises and falls of day 1, ranked within their class.

    Two top-k branches: ranking over a window with only two classes would bring
    each class together in one task.
    """

    def side(prediction: int, order: Column) -> DataFrame:
        best = (
            wide.filter(F.col("day_1_prediction") == prediction)
            .orderBy(order, F.col("ticker").asc())
            .limit(count)
        )
        rank = W.partitionBy("day_1_prediction").orderBy(order, F.col("ticker").asc())
        return best.select(
            F.col("day_1_signal").alias("side"),
            F.row_number().over(rank).alias("rank"),
            "ticker",
            F.col("day_1_probability").alias("probability"),
            F.col("day_1_confidence").alias("confidence"),
        )

    probability = F.col("day_1_probability")
    return side(1, probability.desc()).unionByName(side(0, probability.asc()))


def week_breadth(wide: DataFrame, days: int = 5) -> DataFrame:
    """Rising and falling tickers on each of the first days with a trend label."""
    long = forecast.unpivot(wide, days)
    counts = long.groupBy("day", "date").agg(
        _rows(F.col("prediction") == 1, "up"), _rows(F.col("prediction") == 0, "down")
    )
    total = F.col("up") + F.col("down")
    percent = F.when(total > 0, F.col("up") / total * 100.0)
    return counts.withColumn("up_percent", percent).withColumn(
        "trend", tiers.WEEK.of(F.col("up_percent"))
    )


def recent_tail(table: DataFrame, count: int = 30) -> DataFrame:
    """The last values of one series per ticker, oldest first (``position`` 1)."""
    column = next(
        name
        for name in ("volume_ratio_scaled", "close", "return_1d_scaled")
        if name in table.columns
    )
    back = W.partitionBy("ticker").orderBy(F.col("date").desc())
    tail = (
        table.select("ticker", "date", F.col(column).alias("value"))
        .withColumn("_n", F.row_number().over(back))
        .filter(F.col("_n") <= count)
    )
    ahead = W.partitionBy("ticker").orderBy(F.col("_n").desc())
    return tail.withColumn("position", F.row_number().over(ahead)).drop("_n")


def data_freshness(raw: DataFrame, as_of: str) -> DataFrame:
    """Row count, newest date, its age in days and a label for it."""
    age = F.col("days_old")
    return (
        raw.agg(
            F.count("*").alias("total_rows"),
            F.max(dates.date_part_of(F.col("date"))).alias("latest_date"),
        )
        .withColumn("days_old", F.datediff(F.lit(as_of).cast("date"), F.col("latest_date")))
        .withColumn(
            "freshness",
            F.when(age.isNull(), "UNKNOWN")
            .when(age == 0, "TODAY")
            .when(age == 1, "YESTERDAY")
            .when(age <= 2, "RECENT")
            .otherwise("STALE"),
        )
    )


def report_bundle(
    raw: DataFrame,
    table: DataFrame,
    wide: DataFrame,
    metrics: DataFrame,
    importance: DataFrame,
    as_of: str,
) -> dict[str, DataFrame]:
    """All report tables by name; each is computed when it is read."""
    return {
        "day1_breadth": day1_breadth(wide),
        "day1_top": day1_top(wide),
        "week_breadth": week_breadth(wide),
        "recent_tail": recent_tail(table),
        "data_freshness": data_freshness(raw, as_of),
        "feature_importance": importance,
        "metrics": metrics,
        "forecast_csv": forecast.csv_view(wide),
    }
