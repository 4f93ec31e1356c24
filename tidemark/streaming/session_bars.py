"""Session bars from a stream of ticks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import dates
from tidemark.operators import ingest
from tidemark.sources import months

LATENESS = "2 hours"
_BATCH = "batch"

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)

BARS = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("session", T.IntegerType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)


_STORED = T.StructType([*BARS.fields, T.StructField(_BATCH, T.LongType())])


def read_ticks(spark: SparkSession, folder: str, pattern: str = "events*.parquet") -> DataFrame:
    """Tick files as they arrive in a folder."""
    return (
        spark.readStream.schema(EVENTS)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
        .select(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
            "ts",
            "event_id",
            F.col("value").alias("price"),
            F.lit(1).cast("bigint").alias("volume"),
        )
    )


def _utc_date(instant: Column) -> Column:
    days = F.floor(F.unix_micros(instant) / F.lit(86_400_000_000))
    return F.date_from_unix_date(days.cast("int"))


def session_bars(ticks: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Bars per (ticker, day, session); a tick more than ``lateness`` late is dropped.

    The event time reads the wall clock as UTC, so days do not depend on the
    session time zone. State holds one small row per open (ticker, day, session).
    """
    timed = ingest.with_session(ingest.session_ticks(ticks)).withColumn(
        "event_time", F.timestamp_micros(dates.wall_clock_micros(F.col("ts")))
    )
    return (
        timed.withWatermark("event_time", lateness)
        .groupBy("ticker", F.window("event_time", "1 day").alias("day"), "session")
        .agg(*ingest.ohlcv(("ts", "event_id")))
        .select(
            "ticker",
            _utc_date(F.col("day.start")).alias("trade_date"),
            "session",
            "open",
            "high",
            "low",
            "close",
            "volume",
        )
    )


def upsert(batch: DataFrame, number: int, target: str) -> None:
    """Put a micro-batch's bars into the monthly bars; only months of the batch are rewritten.

    Each stored bar carries the number of the batch it came from, and of two the later one stays. So a
    batch that runs again changes nothing, also after later ones. The ledger holds the newest number
    that was stored whole; a batch up to it is not even read.
    """
    spark = batch.sparkSession
    if number <= last_batch(spark, target):
        return
    new = batch.withColumn(_BATCH, F.lit(number).cast("long"))
    new = new.withColumn(months.MONTH, months.month_of(F.col("trade_date").cast("string"))).persist()
    keys, columns = BARS.fieldNames()[:3], [*BARS.fieldNames(), _BATCH, months.MONTH]
    rows = new.select(*columns)
    touched = months.listed(new)
    if touched and _there(spark, f"{target}/bars"):
        old = months.in_months(months.scan(spark, f"{target}/bars", _STORED), touched)
        rows = rows.unionByName(old.select(*columns))
    if touched:
        values = [name for name in columns if name not in keys]
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), _BATCH).alias("bar"))
        months.write(newest.select(*keys, "bar.*").select(*columns), f"{target}/bars", ["ticker", "trade_date"])
    new.unpersist()
    ledger = spark.range(1).select(F.lit(number).cast("long").alias(_BATCH))
    ledger.coalesce(1).write.mode("overwrite").parquet(f"{target}/ledger")


def last_batch(spark: SparkSession, target: str) -> int:
    """Number of the newest batch in the ledger, -1 for none."""
    if not _there(spark, f"{target}/ledger"):
        return -1
    found = spark.read.schema(f"{_BATCH} long").parquet(f"{target}/ledger").agg(F.max(_BATCH)).first()[0]
    return -1 if found is None else found


def _there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(_STORED).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def run_available(bars: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, store every bar that changed and stop.

    Micro-batches go into the same monthly folders, so files are bounded by months however
    many batches there are. Today's bars are there at once, not when the day closes.
    """
    query = (
        bars.writeStream.outputMode("update")
        .foreachBatch(lambda batch, number: upsert(batch, number, target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stored_bars(spark: SparkSession, target: str) -> DataFrame:
    """Every bar that the stream has stored, in its newest state."""
    return months.scan(spark, f"{target}/bars", BARS).select(*BARS.fieldNames())
