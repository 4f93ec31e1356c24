"""Cut the history of very long tickers into pieces that window on their own.

Cleaned bars are unique per (ticker, trade_date, session), so a ticker grows by
at most three rows a day and the jobs need no cuts. Where a caller's key is finer
than that, one ticker could outgrow a task; ``split`` gives each row a ``part`` and
copies the few rows of context that a window needs across a cut. Windows over
(ticker, part) give the same values as windows over the ticker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.schemas import LOOKAHEAD, LOOKBACK

PART_ROWS = 2_000_000


def split(
    bars: DataFrame,
    part_rows: int = PART_ROWS,
    lookback: int = LOOKBACK,
    lookahead: int = LOOKAHEAD,
) -> DataFrame:
    """Add ``part`` and ``own``; rows with ``own`` false are copies for context.

    The cuts come from row counts per (ticker, day), so the ordered pass below
    sees one row per calendar day and not the bars.
    """
    daily = bars.groupBy("ticker", "trade_date").agg(F.count("*").alias("n"))
    w = W.partitionBy("ticker").orderBy("trade_date")
    before = F.coalesce(
        F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    cut = daily.withColumn("home", F.floor(before / part_rows).cast("int"))
    # Each day holds a row at least, so this many days hold enough context rows.
    around = F.collect_set("home").over(w.rowsBetween(-lookahead, lookback))
    days = cut.select("ticker", "trade_date", "home", around.alias("parts"))
    zero = F.lit(0)
    return (
        bars.join(days, ["ticker", "trade_date"], "left")
        .withColumn("home", F.coalesce("home", zero))
        .withColumn("part", F.explode(F.coalesce("parts", F.array(zero))))
        .withColumn("own", F.col("part") == F.col("home"))
        .drop("home", "parts")
    )


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the context copies again."""
    if "own" not in df.columns:
        return df
    return df.filter("own").drop("own", "part")
