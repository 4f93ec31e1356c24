"""Datasets in monthly folders and what is known of each month.

Beside a dataset lies a small table of facts: per month and ticker the number of rows and
of different keys and the newest key. Each month's facts carry the state of the files they were
taken from (number, bytes, newest change), which a file listing gives without opening a
file. Months whose files have changed since are counted anew, all others are taken as they are,
so jobs find newest dates, counts and newest rows without reading what did not change.

A dataset without monthly folders counts as one month without a name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.schemas import T
from tidemark.sources import store

MONTH = "month"
# The folder of rows without a readable date.
NO_MONTH = "unreadable"

FACTS = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("keys", T.LongType()),
        T.StructField("newest_key", T.StringType()),
        T.StructField("newest_date", T.DateType()),
        T.StructField("files", T.StringType()),
        T.StructField(MONTH, T.StringType()),
    ]
)


def month_of(date: Column) -> Column:
    """The folder of a row with this date text."""
    month = F.substring(dates.date_part_of(date).cast("string"), 1, 7)
    return F.coalesce(month, F.lit(NO_MONTH))


def write(rows: DataFrame, path: str, order: list[str], whole: bool = False, moved: bool = True) -> None:
    """Write rows with their ``month`` into its folders; only months at hand are replaced.

    With ``whole`` all others go. The rebalance step lets the adaptive planner cut a month that is much larger
    than the others into several files and join small ones. Without ``moved`` rows stay in their tasks, each of which
    writes a file for every month it has: no disk for a shuffle, but as many files a month as there are tasks.
    """
    with store.freed(rows.sparkSession):
        (
            (rows.hint("rebalance", F.col(MONTH)) if moved else rows)
            .sortWithinPartitions(MONTH, *order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if whole else "dynamic")
            .partitionBy(MONTH)
            .parquet(path)
        )


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows with their ``month``; empty text where there are no monthly folders."""
    full = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
    return spark.read.schema(full).parquet(path)


def listed(df: DataFrame, column: str = MONTH) -> list[str]:
    """Different months of a frame, in order: as many as the calendar has."""
    return df.agg(F.sort_array(F.collect_set(column))).first()[0]


def in_months(rows: DataFrame, months: list[str]) -> DataFrame:
    """Rows of these months; others are not read."""
    if months == [""]:
        return rows.withColumn(MONTH, F.lit(""))
    return rows.filter(F.col(MONTH).isin(months))


def _files(spark: SparkSession, path: str) -> DataFrame | None:
    """``month`` and the state of its files from listings alone; None if nothing is there."""
    try:
        found = spark.read.format("binaryFile").options(
            pathGlobFilter="*.parquet", recursiveFileLookup="true"
        ).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    state = F.concat_ws(
        "-", F.count("*"), F.sum("length"), F.unix_micros(F.max("modificationTime"))
    )
    month = F.regexp_extract("path", f"/{MONTH}=([^/]+)/[^/]+$", 1)
    return found.groupBy(month.alias(MONTH)).agg(state.alias("files"))


def states(spark: SparkSession, path: str) -> list:
    """``month`` and the state of its files as they are now; a row per calendar month."""
    found = _files(spark, path)
    return [] if found is None else found.agg(F.collect_list(F.struct(MONTH, "files"))).first()[0]


def _counted(rows: DataFrame, once: bool = False) -> DataFrame:
    """Facts of the rows; keys are combined in every task before they are shuffled.

    With ``once`` no two rows have the same key, so only tickers are counted. The newest key is found
    as a number: the largest of texts would have every task sort its keys.
    """
    per_key = rows.select(MONTH, "ticker", "date", F.lit(1).cast("long").alias("rows"))
    if not once:
        per_key = rows.groupBy(MONTH, "ticker", "date").agg(F.count("*").alias("rows"))
    newest = F.col("_newest")
    day = F.date_from_unix_date(F.floor(newest / dates.SESSIONS).cast("int"))
    return (
        per_key.groupBy(MONTH, "ticker")
        .agg(
            F.sum("rows").alias("rows"),
            F.count("*").alias("keys"),
            F.max(dates.key_number(F.col("date"))).alias("_newest"),
        )
        .withColumn("newest_key", dates.session_key(day, F.pmod(newest, F.lit(dates.SESSIONS))))
        .withColumn("newest_date", day)
        .drop("_newest")
    )


def facts_path(path: str) -> str:
    return path.rstrip("/") + "_facts"


def facts(spark: SparkSession, path: str, schema: T.StructType, before: list | None = None) -> DataFrame:
    """The dataset's facts, brought up to date: only months with changed files are read.

    ``before`` holds the ``states`` before a merge; in months whose files are others now every key stands once.
    """
    state = _files(spark, path)
    if state is None:
        return spark.createDataFrame([], FACTS)
    where = facts_path(path)
    stored = None if _files(spark, where) is None else spark.read.schema(FACTS).parquet(where)
    changed = state
    if stored is not None:
        known = stored.select(MONTH, "files").distinct().withColumn(MONTH, _name())
        changed = state.join(known, [MONTH, "files"], "left_anti")
    stale = listed(changed)
    if stored is None and not stale:
        return spark.createDataFrame([], FACTS)
    if stale:
        rows = scan(spark, path, schema).select("date", "ticker", MONTH)
        merged = []
        if before is not None:
            old = spark.createDataFrame(before, f"{MONTH} string, files string")
            merged = listed(changed.join(old, [MONTH, "files"], "left_anti"))
        other = [month for month in stale if month not in merged]
        parts = [_counted(in_months(rows, part), once) for part, once in ((other, False), (merged, True)) if part]
        # One row per calendar month.
        fresh = reduce(DataFrame.unionByName, parts).join(F.broadcast(state), MONTH)
        write(fresh.select(*FACTS.fieldNames()).withColumn(MONTH, _folder()), where, ["ticker"])
    # Months that are gone, or were written since, do not count.
    stored = spark.read.schema(FACTS).parquet(where).withColumn(MONTH, _name())
    return stored.join(F.broadcast(state), [MONTH, "files"], "left_semi").select(*FACTS.fieldNames())


# A folder needs a name where a month has none.
_NAMELESS = "whole"


def _folder() -> Column:
    return F.when(F.col(MONTH) == "", _NAMELESS).otherwise(F.col(MONTH))


def _name() -> Column:
    return F.when(F.col(MONTH) == _NAMELESS, "").otherwise(F.col(MONTH))


def newest_months(known: DataFrame) -> DataFrame:
    """The month in which each ticker ends, by its newest key."""
    last = F.max(F.struct("newest_key", MONTH))[MONTH]
    return known.groupBy("ticker").agg(last.alias(MONTH))


def ending_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of each ticker's last month.

    Tickers that are still traded end in the newest months, so those are read, and of the
    others only months in which some ticker ends; a stale ticker costs its month alone.
    """
    last = newest_months(facts(spark, path, schema))
    rows = in_months(scan(spark, path, schema), listed(last))
    ends = last.select(F.col("ticker").alias("_ticker"), F.col(MONTH).alias("_month"))
    same = F.col("ticker").eqNullSafe(F.col("_ticker")) & (F.col(MONTH) == F.col("_month"))
    return rows.join(ends, same, "left_semi").select(*schema.fieldNames())


def halo(
    known: DataFrame, tickers: DataFrame, before: str, keys: int
) -> DataFrame:
    """``ticker, month`` pairs before a month that hold the last ``keys`` keys of each ticker.

    All older months of a ticker that has fewer. The running totals are over months, not bars.
    """
    older = known.filter((F.col(MONTH) < before) & F.col("newest_key").isNotNull())
    older = older.join(tickers.select("ticker"), "ticker", "left_semi")
    later = F.expr(f"coalesce(sum(keys) over (partition by ticker order by {MONTH} desc rows between unbounded preceding and 1 preceding), 0)")
    return older.withColumn("_later", later).filter(F.col("_later") < keys).select("ticker", MONTH)
