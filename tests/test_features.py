import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import tiers
from tidemark.operators import features, latest, scale, segments
from tidemark.sources import sample


def table(df, *columns):
    return [tuple(r) for r in df.orderBy("ticker", "trade_date", "session").select(*columns).collect()]


def test_zero_divisors_take_the_defaults(make_bars):
    bars = make_bars(
        [
            ("AAA", 0, 0, 0, 0, 0, 0, 0),
            ("AAA", 1, 0, 0, 2, 1, 0, 0),
        ]
    )
    second = table(
        features.with_features(bars),
        "return_1d",
        "oc_return",
        "price_vs_ma5",
        "volume_ratio",
        "volume_change",
        "hl_range",
    )[1]
    assert second == (0.0, 0.0, 1.0, 1.0, 0.0, 0.0)


def test_flat_bar_sits_in_the_middle(flat_series):
    assert table(features.with_features(flat_series([5.0])), "close_position") == [(0.5,)]


def test_ties_are_not_rises_and_last_bar_is_open(flat_series):
    got = table(features.with_target(flat_series([5.0, 5.0, 6.0, 4.0])), "target")
    assert got == [(0,), (1,), (0,), (None,)]


def test_warm_up_drops_ten_bars(flat_series):
    rows = features.feature_rows(flat_series([float(i) for i in range(1, 13)]))
    assert rows.count() == 2


def test_values_against_hand_computation(flat_series):
    closes = [10.0, 11.0, 12.1, 11.5, 12.0, 12.6, 13.0, 12.2, 12.8, 13.5, 14.0, 13.1]
    volumes = [float(100 + 7 * i) for i in range(12)]
    last = features.feature_rows(flat_series(closes, volumes=volumes)).orderBy("trade_date").tail(1)[0]
    returns = [b / a - 1 for a, b in zip(closes, closes[1:], strict=False)]
    expected = {
        "return_1d": returns[-1],
        "return_3d": closes[-1] / closes[-4] - 1,
        "return_5d": closes[-1] / closes[-6] - 1,
        "return_10d": closes[-1] / closes[-11] - 1,
        "price_vs_ma5": closes[-1] / statistics.mean(closes[-5:]),
        "price_vs_ma10": closes[-1] / statistics.mean(closes[-10:]),
        "ma5_vs_ma10": statistics.mean(closes[-5:]) / statistics.mean(closes[-10:]),
        "volume_ratio": volumes[-1] / statistics.mean(volumes),
        "volume_change": volumes[-1] / volumes[-2] - 1,
        "volatility_5": statistics.stdev(returns[-5:]),
        "volatility_10": statistics.stdev(returns[-10:]),
        "oc_return": 0.0,
        "hl_range": 0.0,
        "close_position": 0.5,
        "return_lag1": returns[-2],
        "return_lag2": returns[-3],
        "return_lag3": returns[-4],
    }
    assert set(expected) == set(schemas.FEATURES)
    for name, value in expected.items():
        assert last[name] == pytest.approx(value, abs=1e-12), name


def test_sessions_order_inside_a_day(make_bars):
    bars = make_bars(
        [
            ("AAA", 0, 2, 1, 1, 1, 3, 1),
            ("AAA", 1, 0, 1, 1, 1, 4, 1),
            ("AAA", 0, 1, 1, 1, 1, 2, 1),
            ("AAA", 0, 0, 1, 1, 1, 1, 1),
        ]
    )
    got = table(features.with_lags(bars), "close", "prev_close_1")
    assert got == [(1.0, None), (2.0, 1.0), (3.0, 2.0), (4.0, 3.0)]


@pytest.fixture(scope="module")
def month_rows(spark):
    return features.feature_rows(sample.bars(spark, "/root/testdata/sf0.001"))


def test_close_position_stays_in_range(month_rows):
    low, high = month_rows.agg(F.min("close_position"), F.max("close_position")).first()
    assert 0.0 <= low <= high <= 1.0


def test_zscores_are_standard(month_rows):
    scaled = scale.zscore(month_rows)
    got = scaled.agg(
        *(F.avg(c).alias(f"m_{c}") for c in schemas.SCALED),
        *(F.stddev(c).alias(f"s_{c}") for c in schemas.SCALED),
    ).first()
    for name in schemas.SCALED:
        assert got[f"m_{name}"] == pytest.approx(0.0, abs=1e-9)
        assert got[f"s_{name}"] == pytest.approx(1.0, abs=1e-9)


def test_constant_and_single_row_scale_to_zero(flat_series):
    constant = features.feature_rows(flat_series([7.0] * 14))
    assert constant.count() == 4
    for rows in (constant, constant.orderBy("trade_date").limit(1)):
        for r in scale.zscore(rows).select(*schemas.SCALED).collect():
            assert set(r) == {0.0}


def test_stored_scaler_gives_the_same_values(month_rows, spark):
    stored = spark.createDataFrame(scale.scaler_stats(month_rows).collect(), schemas.SCALER)
    mine = scale.zscore(month_rows, scale.scaler_row_of(stored), digits=9)
    whole = scale.zscore(month_rows, digits=9)
    assert mine.select(*schemas.SCALED).exceptAll(whole.select(*schemas.SCALED)).isEmpty()


def _random_bars(make_bars, closes):
    rows = []
    for ticker, values in closes.items():
        for i, value in enumerate(values):
            rows.append((ticker, i // 3, i % 3, value, value + 1, value - 1, value, 10 + value))
    return make_bars(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    part_rows=st.integers(1, 40),
    closes=st.lists(st.integers(1, 50), min_size=30, max_size=90),
)
def test_split_tickers_give_the_same_rows(make_bars, part_rows, closes):
    bars = _random_bars(make_bars, {"HOT": closes, "COLD": closes[:15]})
    whole = features.feature_rows(bars)
    parts = features.feature_rows(segments.split(bars, part_rows=part_rows))
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))


def test_only_long_tickers_are_split(make_bars):
    bars = _random_bars(make_bars, {"HOT": list(range(1, 91)), "COLD": list(range(1, 31))})
    split = segments.split(bars, 50)
    parts = {r.ticker: r.n for r in split.groupBy("ticker").agg(F.count_distinct("part").alias("n")).collect()}
    assert parts["COLD"] == 1 and parts["HOT"] >= 2
    assert split.filter("own").count() == bars.count()
    assert sorted(map(str, features.feature_rows(split).collect())) == sorted(
        map(str, features.feature_rows(bars).collect())
    )


def test_target_distribution(flat_series):
    got = features.target_distribution(features.with_target(flat_series([1.0, 2.0, 1.0, 2.0, 3.0])))
    assert {(r.label, r.rows, r.percent) for r in got.collect()} == {
        ("UP", 3, 75.0),
        ("DOWN", 1, 25.0),
    }
    empty = features.target_distribution(features.with_target(flat_series([1.0])))
    assert empty.count() == 0


def test_latest_takes_the_last_session(make_bars):
    bars = make_bars(
        [
            ("AAA", 0, 2, 1, 1, 1, 3, 30),
            ("AAA", 0, 1, 1, 1, 1, 2, 20),
            ("BBB", 4, 0, 1, 1, 1, 9, 90),
        ]
    )
    got = {r.ticker: (r.close, r.volume) for r in latest.stock_info(bars).collect()}
    assert got == {"AAA": (3.0, 30.0), "BBB": (9.0, 90.0)}


@pytest.mark.parametrize(
    ("p", "tier"),
    [(0.3, "HIGH"), (0.31, "MEDIUM"), (0.39, "MEDIUM"), (0.4, "LOW"), (0.6, "LOW"), (0.61, "MEDIUM"), (0.7, "HIGH")],
)
def test_tiers(spark, p, tier):
    got = spark.range(1).select(
        tiers.confidence_tier(F.lit(p)).alias("a"),
        tiers.horizon_tier(F.lit(p), F.lit(1)).alias("b"),
    ).first()
    assert (got.a, got.b) == (tier, tier)


def test_horizon_tier_over_days(spark):
    grid = spark.range(0, 1001).select((F.col("id") / 1000).alias("p")).crossJoin(
        spark.range(1, 16).select(F.col("id").cast("int").alias("day"))
    )
    seen = grid.select("day", tiers.horizon_tier(F.col("p"), F.col("day")).alias("t"))
    by_day = {r.day: set(r.t) for r in seen.groupBy("day").agg(F.collect_set("t").alias("t")).collect()}
    assert all("MEDIUM" in by_day[d] for d in range(1, 6))
    assert all("MEDIUM" not in by_day[d] for d in range(6, 16))
    assert all(by_day[d] == {"HIGH"} for d in range(11, 16))
    floored = grid.select("day", tiers.horizon_tier(F.col("p"), F.col("day"), 0.62).alias("t"))
    kept = {r.day: set(r.t) for r in floored.groupBy("day").agg(F.collect_set("t").alias("t")).collect()}
    assert all(kept[d] == {"HIGH", "MEDIUM", "LOW"} for d in kept)
