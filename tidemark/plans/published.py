"""Tables that the daily jobs publish and the questions read.

Each is written once per Spark application and test folder, in the shared folder,
and read back as parquet, just as a deployment serves what its last run wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import dates, scoring, tiers
from tidemark.operators import features, forecast, ingest, latest, models, scale
from tidemark.schemas import T
from tidemark.sources import files, sample, store

# The day the checks pretend to run on.
AS_OF = "2024-01-31"
# Scaled values are stored to six digits, so that later steps start from the
# same numbers whatever order the means were summed in.
DIGITS = 6


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.to_raw(sample.bars(spark, sf_dir))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.feature_rows(sample.bars(spark, sf_dir))
    return scale.feature_table(rows, digits=DIGITS)


def _info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.stock_info(sample.bars(spark, sf_dir))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest.latest_features(read(spark, sf_dir, "features"))
    return forecast.forecast(sample.BLEND, newest, AS_OF)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.to_wide(entries(spark, sf_dir))


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.to_long(entries(spark, sf_dir))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction from every feature row, made on the last day of its month."""
    table = read(spark, sf_dir, "features")
    day = dates.date_part_of(F.col("date"))
    made = F.last_day("latest_data_date")
    return (
        models.score(sample.BLEND, table)
        .withColumn("latest_data_date", day)
        .withColumn("prediction_date", made)
        .withColumn("predicted_for_date", dates.next_trading_day(made))
        .withColumn("signal", tiers.signal(F.col("prediction")))
        .withColumn("confidence", tiers.confidence_tier(F.col("probability")))
        .select(*schemas.NEXT_SESSION.fieldNames())
    )


_BUILD: dict[str, tuple[Callable[[SparkSession, str], DataFrame], T.StructType]] = {
    "raw": (_raw, schemas.RAW_BARS),
    "features": (_features, schemas.FEATURE_TABLE),
    "info": (_info, schemas.STOCK_INFO),
    "wide": (_wide, schemas.forecast_wide()),
    "long": (_long, schemas.FORECAST_LONG),
    "history": (_history, schemas.NEXT_SESSION),
}
_paths: dict[tuple[str, str, str], str] = {}


def path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where the table lies; writes it on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _paths:
        target = store.new_path(spark, name)
        build, _ = _BUILD[name]
        data = build(spark, sf_dir)
        if name == "history":
            files.save_predictions(data, target)
        else:
            data.write.parquet(target)
        _paths[key] = target
    return _paths[key]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _, schema = _BUILD[name]
    return spark.read.schema(schema).parquet(path(spark, sf_dir, name))


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled row scored by each fixed scorer: one row per row and model."""
    table = read(spark, sf_dir, "features").filter(F.col("target").isNotNull())
    scored = F.array(
        *(
            F.struct(F.lit(s.name).alias("model"), s.on_scaled().alias("probability"))
            for s in sample.SCORERS
        )
    )
    return (
        table.select("ticker", "date", "target", F.explode(scored).alias("s"))
        .select("ticker", "date", "target", "s.*")
        .withColumn("prediction", scoring.hard_class(F.col("probability")))
    )
