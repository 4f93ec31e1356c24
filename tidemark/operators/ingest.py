"""Bar building, merging new data into old, and the ingest decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.schemas import PRICES


def normalize_history(vendor: DataFrame, ticker: str | None = None) -> DataFrame:
    """Vendor bars (``time`` first) as raw bars with a ``YYYY-MM-DD`` text date."""
    name = F.lit(ticker) if ticker else F.col("ticker")
    return vendor.select(
        F.to_date("time").cast("string").alias("date"),
        name.alias("ticker"),
        *PRICES,
        "volume",
    )


def universe_filter(bars: DataFrame, universe: DataFrame) -> DataFrame:
    """Keep the bars of listed tickers.

    A semi join without a hint: the optimizer broadcasts the list while its
    measured size is under the session's limit and shuffles it beyond that.
    """
    return bars.join(universe.select("ticker"), "ticker", "left_semi")


def universe_missing(universe: DataFrame, bars: DataFrame) -> DataFrame:
    """Listed tickers without a single bar."""
    have = bars.groupBy("ticker").agg(F.lit(1).alias("have"))
    return universe.select("ticker").join(have, "ticker", "left_anti")


def with_session(ticks: DataFrame, zone: str | None = None) -> DataFrame:
    """Add ``session`` (1 or 2). With ``zone`` the timestamp is a UTC instant."""
    ts = dates.local_time(F.col("ts"), zone) if zone else F.col("ts")
    return ticks.withColumn("session", dates.session_of(ts))


def session_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks inside the two sessions."""
    return ticks.filter(dates.in_session(F.col("ts")))


def ohlcv(order: Sequence[str]) -> list[Column]:
    """First, highest, lowest, last price and summed volume in ``order``.

    The price is taken from the key where it is part of it, so that one value is kept for each end.
    """
    key = F.struct(*order)
    first, last = F.min_by("price", key), F.max_by("price", key)
    if "price" in order:
        first, last = F.min(key)["price"], F.max(key)["price"]
    return [
        first.alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        last.alias("close"),
        F.sum("volume").alias("volume"),
    ]


def session_bars(ticks: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Ticks to one bar per (ticker, day, session); combined before the shuffle."""
    inside = with_session(session_ticks(ticks))
    return inside.groupBy(
        "ticker", F.to_date("ts").alias("trade_date"), "session"
    ).agg(*ohlcv(order))


def to_raw(bars: DataFrame) -> DataFrame:
    """Typed bars with the text date used in the raw dataset."""
    return bars.select(
        dates.session_key(F.col("trade_date"), F.col("session")).alias("date"),
        "ticker",
        *PRICES,
        "volume",
    )


def last_date(raw: DataFrame) -> DataFrame:
    """One row: are there rows, and the newest date with markers stripped."""
    return raw.agg(
        (F.count("*") > 0).alias("has_rows"),
        F.max(dates.date_part_of(F.col("date"))).alias("last_date"),
    )


def union_new(history: DataFrame, intraday: DataFrame) -> DataFrame:
    return history.unionByName(intraday)


def upsert_keep_last(
    existing: DataFrame,
    new: DataFrame,
    keys: Sequence[str] = ("date", "ticker"),
    arrival: Sequence[str] = (),
) -> DataFrame:
    """Merge by key; the newest arrival wins.

    New rows beat existing ones; inside a side the larger ``arrival`` columns
    win, and after those the larger remaining values, so the result is fixed. Rows are sorted by
    the last key first: date texts begin alike, and sorting by them compares whole rows.
    """
    columns = existing.columns
    rest = [name for name in columns if name not in keys and name not in arrival]
    both = existing.withColumn("_src", F.lit(0)).unionByName(
        new.withColumn("_src", F.lit(1)), allowMissingColumns=bool(arrival)
    )
    order = [F.col(name).desc() for name in ("_src", *arrival, *rest)]
    w = W.partitionBy(*reversed(keys)).orderBy(*order)
    return (
        both.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(*columns)
    )


def sort_bars(bars: DataFrame) -> DataFrame:
    """Order rows inside each partition for writing; no global sort."""
    names = bars.columns
    order = ["ticker", "date"] if "date" in names else ["ticker", "trade_date", "session"]
    return bars.sortWithinPartitions(*order)


def _strategy(last: Column, as_of: Column) -> Column:
    yesterday = F.date_sub(as_of, 1)
    return (
        F.when(last.isNull(), "full").when(last < yesterday, "gap").otherwise("intraday")
    )


def _plan(frame: DataFrame, as_of: str, years: int) -> DataFrame:
    today = F.lit(as_of).cast("date")
    strategy = F.col("strategy")
    with_history = strategy != "intraday"
    return (
        frame.withColumn("strategy", _strategy(F.col("last_date"), today))
        .withColumn("fetch_history", with_history)
        .withColumn("fetch_intraday", F.lit(True))
        .withColumn(
            "history_start",
            F.when(strategy == "full", F.date_sub(today, years * 365)).when(
                strategy == "gap", F.date_add("last_date", 1)
            ),
        )
        .withColumn("history_end", F.when(with_history, F.date_sub(today, 1)))
    )


def fetch_plan(
    bars: DataFrame, universe: DataFrame, as_of: str, years: int = 5
) -> DataFrame:
    """What each listed ticker still needs: full load, gap fill or today only."""
    newest = bars.groupBy("ticker").agg(F.max("trade_date").alias("last_date"))
    listed = universe.select("ticker").join(newest, "ticker", "left")
    return _plan(listed, as_of, years)


def fetch_plan_all(bars: DataFrame, as_of: str, years: int = 5) -> DataFrame:
    """The same decision once for the whole dataset."""
    return _plan(bars.agg(F.max("trade_date").alias("last_date")), as_of, years)


def recent_days(bars: DataFrame, days: int) -> DataFrame:
    """Bars no older than ``days`` before the newest bar."""
    newest = bars.agg(F.max("trade_date")).scalar()
    return bars.filter(F.col("trade_date") >= F.date_sub(newest, days))


def freshness_gate(
    raw: DataFrame,
    state: DataFrame,
    as_of: str,
    check: bool = True,
    force: bool = False,
) -> DataFrame:
    """One row: newest key, its age, whether it is news, and whether to run.

    Keys are compared in canonical form; rows without a readable date count as rows
    but never as the newest.
    """
    newest = raw.agg(
        F.max(dates.canonical_key(F.col("date"))).alias("latest_date"),
        F.count("*").alias("total_rows"),
    )
    return gate(newest, state, as_of, check, force)


def gate(
    newest: DataFrame, state: DataFrame, as_of: str, check: bool = True, force: bool = False
) -> DataFrame:
    """The same from one row of ``latest_date`` and ``total_rows``.

    ``state`` has at most one row (``latest_date`` text, ``last_processed_at``).
    """
    seen = state.agg(
        F.max(dates.canonical_key(F.col("latest_date"))).alias("latest_date"),
        F.max("last_processed_at").alias("last_processed_at"),
    )
    cached = seen.select("latest_date").scalar()
    fresh = F.col("cached_date").isNull() | (F.col("latest_date") > F.col("cached_date"))
    day = dates.date_part_of(F.col("latest_date"))
    return (
        newest.withColumn("cached_date", cached)
        .withColumn("days_old", F.coalesce(F.datediff(F.lit(as_of).cast("date"), day), F.lit(0)))
        .withColumn("has_new_data", F.coalesce(fresh, F.lit(False)))
        .withColumn(
            "should_run",
            F.lit(not check) | F.col("has_new_data") | F.lit(force),
        )
        .withColumn("success", F.col("latest_date").isNotNull())
        .withColumn(
            "last_processed_at", seen.select("last_processed_at").scalar()
        )
    )


def ingest_summary(
    existing: DataFrame, history: DataFrame, intraday: DataFrame, untouched: DataFrame | None = None
) -> DataFrame:
    """Row counts of each input and of the merge, from one keyed aggregate.

    ``untouched`` holds facts (``rows``, ``keys``) of stored months that no new row falls into;
    ``existing`` then needs the rows of the other months only.
    """
    tagged = None
    for name, frame in (("existing", existing), ("history", history), ("intraday", intraday)):
        part = frame.select("date", "ticker", F.lit(name).alias("src"))
        tagged = part if tagged is None else tagged.unionByName(part)

    def rows(name: str) -> Column:
        return F.count(F.when(F.col("src") == name, 1)).alias(name)

    by_key = tagged.groupBy("date", "ticker").agg(
        rows("existing"), rows("history"), rows("intraday")
    )
    counts = by_key.agg(
        F.sum("history").alias("history_rows"),
        F.sum("intraday").alias("intraday_rows"),
        F.sum(F.col("history") + F.col("intraday")).alias("new_rows"),
        F.sum("existing").alias("existing_rows"),
        F.sum(F.col("existing") + F.col("history") + F.col("intraday")).alias("merged_rows"),
        F.count("*").alias("deduped_rows"),
    )
    if untouched is None:
        return counts
    held = untouched.agg(
        F.struct(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("rows", "keys"))).alias("held")
    ).scalar()
    zero = F.lit(0)
    return counts.withColumn("_held", held).select(
        *(F.coalesce(name, zero).alias(name) for name in ("history_rows", "intraday_rows", "new_rows")),
        (F.coalesce("existing_rows", zero) + F.col("_held.rows")).alias("existing_rows"),
        (F.coalesce("merged_rows", zero) + F.col("_held.rows")).alias("merged_rows"),
        (F.col("deduped_rows") + F.col("_held.keys")).alias("deduped_rows"),
    )
