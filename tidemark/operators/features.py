"""The seventeen windowed indicators and the next-bar label.

All windows share one key and one order, so a plan holds a single exchange and
sort by ticker. Input bars are unique per (ticker, trade_date, session); see
``segments`` for tickers too long for one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.segments import own_rows
from tidemark.schemas import FEATURES

KEYS = ("ticker", "trade_date", "session")

SHORT = 5
LONG = 10
VOLUME_BARS = 20


def by_ticker(bars: DataFrame) -> WindowSpec:
    keys = ["ticker", "part"] if "part" in bars.columns else ["ticker"]
    return W.partitionBy(*keys).orderBy("trade_date", "session")


def _last(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(-(rows - 1), 0)


def _ratio(top: Column, bottom: Column, at_zero: float) -> Column:
    return F.when(bottom == 0, at_zero).otherwise(top / bottom)


def with_lags(bars: DataFrame) -> DataFrame:
    """Close 1, 3, 5 and 10 bars ago and volume one bar ago."""
    w = by_ticker(bars)
    return bars.withColumns(
        {
            **{f"prev_close_{n}": F.lag("close", n).over(w) for n in (1, 3, 5, 10)},
            "prev_volume_1": F.lag("volume", 1).over(w),
        }
    )


def with_averages(
    bars: DataFrame, short: int = SHORT, long: int = LONG, volume_bars: int = VOLUME_BARS
) -> DataFrame:
    """Moving means of close and volume; short frames at the start count as they are."""
    w = by_ticker(bars)
    return bars.withColumns(
        {
            "ma5": F.avg("close").over(_last(w, short)),
            "ma10": F.avg("close").over(_last(w, long)),
            "avg_vol20": F.avg("volume").over(_last(w, volume_bars)),
        }
    )


def with_features(
    bars: DataFrame, short: int = SHORT, long: int = LONG, volume_bars: int = VOLUME_BARS
) -> DataFrame:
    """All seventeen features, with NULLs left in the warm-up rows."""
    w = by_ticker(bars)
    c = F.col
    close, spread = c("close"), c("high") - c("low")

    def change(now: str, then: str) -> Column:
        return _ratio(c(now) - c(then), c(then), 0.0)

    first = with_averages(with_lags(bars), short, long, volume_bars).withColumns(
        {
            **{f"return_{n}d": change("close", f"prev_close_{n}") for n in (1, 3, 5, 10)},
            "price_vs_ma5": _ratio(close, c("ma5"), 1.0),
            "price_vs_ma10": _ratio(close, c("ma10"), 1.0),
            "ma5_vs_ma10": _ratio(c("ma5"), c("ma10"), 1.0),
            "volume_ratio": _ratio(c("volume"), c("avg_vol20"), 1.0),
            "volume_change": change("volume", "prev_volume_1"),
            "oc_return": F.when(c("open") == 0, 0.0).otherwise(close / c("open") - 1.0),
            "hl_range": _ratio(spread, close, 0.0),
            "close_position": _ratio(close - c("low"), spread, 0.5),
        }
    )
    return first.withColumns(
        {
            "volatility_5": F.stddev("return_1d").over(_last(w, short)),
            "volatility_10": F.stddev("return_1d").over(_last(w, long)),
            **{f"return_lag{n}": F.lag("return_1d", n).over(w) for n in (1, 2, 3)},
        }
    )


def with_target(bars: DataFrame) -> DataFrame:
    """1 if the next close is higher, 0 if not (ties too), NULL on the last bar."""
    following = F.lead("close", 1).over(by_ticker(bars))
    return bars.withColumn("_next", following).withColumn(
        "target",
        F.when(F.col("_next") > F.col("close"), 1).when(F.col("_next").isNotNull(), 0),
    ).drop("_next")


def feature_rows(bars: DataFrame, **windows: int) -> DataFrame:
    """Keys, close, target and the features of every row that has them all."""
    full = own_rows(with_target(with_features(bars, **windows)))
    return full.select(*KEYS, "close", "target", *FEATURES).dropna(subset=list(FEATURES))


def target_distribution(labelled: DataFrame) -> DataFrame:
    """Rows and share per label; unlabelled rows do not count."""
    counts = (
        labelled.filter(F.col("target").isNotNull())
        .groupBy("target")
        .agg(F.count("*").alias("rows"))
    )
    # At most two rows reach this window.
    total = F.sum("rows").over(W.partitionBy(F.lit(1)))
    return counts.select(
        "target",
        F.when(F.col("target") == 1, "UP").otherwise("DOWN").alias("label"),
        "rows",
        F.when(total > 0, F.col("rows") / total * 100.0).otherwise(0.0).alias("percent"),
    )
