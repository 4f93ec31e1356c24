"""Z-score scaling and the published feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.functions.numbers import to_digits
from tidemark.schemas import FEATURE_TABLE, FEATURES


def scaler_row(features: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of each feature, in one wide row."""
    stats: list[Column] = []
    for name in FEATURES:
        stats.append(F.avg(name).alias(f"{name}_mean"))
        stats.append(F.stddev(name).alias(f"{name}_std"))
    return features.agg(*stats)


def scaler_stats(features: DataFrame) -> DataFrame:
    """The same figures as one row per feature, ready to be stored with a run."""
    rows = ", ".join(f"'{name}', {name}_mean, {name}_std" for name in FEATURES)
    return scaler_row(features).selectExpr(
        f"stack({len(FEATURES)}, {rows}) AS (feature, mean, std)"
    )


def scaler_row_of(stats: DataFrame) -> DataFrame:
    """A stored per-feature table back in the wide form."""
    columns: list[Column] = []
    for name in FEATURES:
        here = F.col("feature") == name
        columns.append(F.max(F.when(here, F.col("mean"))).alias(f"{name}_mean"))
        columns.append(F.max(F.when(here, F.col("std"))).alias(f"{name}_std"))
    return stats.agg(*columns)


def month_moments(features: DataFrame, month: Column) -> DataFrame:
    """Count, mean and second central moment of each feature in each month: a row per month and feature."""
    stats: list[Column] = []
    for name in FEATURES:
        stats.append(F.count(name).cast("double").alias(f"{name}_n"))
        stats.append(F.avg(name).alias(f"{name}_mean"))
        stats.append((F.var_pop(name) * F.count(name)).alias(f"{name}_m2"))
    rows = ", ".join(f"'{name}', {name}_n, {name}_mean, {name}_m2" for name in FEATURES)
    return features.groupBy(month.alias("month")).agg(*stats).selectExpr(
        "month", f"stack({len(FEATURES)}, {rows}) AS (feature, n, mean, m2)"
    )


def merge_moments(moments: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of each feature over all months.

    Months are joined in their order by the pairwise update of means and second moments, which
    loses no digits where means are large; a feature has one row per calendar month.
    """
    parts = F.sort_array(F.collect_list(F.struct("month", "n", "mean", "m2")))
    nothing = F.struct(*(F.lit(0.0).alias(name) for name in ("n", "mean", "m2")))

    def joined(a: Column, b: Column) -> Column:
        n, away = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + away * (b["n"] / n)).alias("mean"),
            (a["m2"] + b["m2"] + away * away * (a["n"] * b["n"] / n)).alias("m2"),
        )

    whole = moments.filter("n > 0").groupBy("feature").agg(F.aggregate(parts, nothing, joined).alias("s"))
    spread = F.when(F.col("s.n") > 1, F.sqrt(F.col("s.m2") / (F.col("s.n") - 1)))
    return whole.select("feature", F.col("s.mean").alias("mean"), spread.alias("std"))


def zscore(
    features: DataFrame, scaler: DataFrame | None = None, digits: int | None = None
) -> DataFrame:
    """Add ``<feature>_scaled``; a feature that does not vary scales to 0.

    ``scaler`` is a one-row frame from ``scaler_row`` (training rows only, or a
    stored run); by default all given rows are used. It enters as one scalar
    subquery, so the exchange below the features is read twice, not built twice.
    The case of a constant feature is settled in that one row: division by
    infinity gives 0, and the code generated for each row stays short.
    """
    fitted = scaler_row(features) if scaler is None else scaler
    parts: list[Column] = []
    for name in FEATURES:
        std = F.col(f"{name}_std")
        parts.append(F.col(f"{name}_mean"))
        parts.append(F.when(std > 0, std).otherwise(float("inf")).alias(f"{name}_std"))
    row = fitted.select(F.struct(*parts)).scalar()
    held = features.withColumn("_fit", row)

    def scaled(name: str) -> Column:
        value = (F.col(name) - F.col(f"_fit.{name}_mean")) / F.col(f"_fit.{name}_std")
        # The sum with zero turns -0.0 into 0.0.
        return value + F.lit(0.0) if digits is None else to_digits(value, digits)

    return held.withColumns({f"{name}_scaled": scaled(name) for name in FEATURES}).drop("_fit")


def feature_table(
    features: DataFrame, scaler: DataFrame | None = None, digits: int | None = None
) -> DataFrame:
    """Scaled features in the published layout."""
    key = dates.session_key(F.col("trade_date"), F.col("session"))
    return (
        zscore(features, scaler, digits)
        .withColumn("date", key)
        .select(*FEATURE_TABLE.fieldNames())
    )
