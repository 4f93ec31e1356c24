import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import tiers
from tidemark.operators import predictions, report, serving
from tidemark.plans import published

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wide(spark):
    return published.read(spark, SMALL, "wide")


def make_wide(spark, rows):
    """Day-1 rows (ticker, date, prediction, probability, tier); other days empty."""
    base = spark.createDataFrame(
        rows, "ticker string, d string, p int, q double, c string"
    )
    given = {
        "ticker": F.col("ticker"),
        "latest_data_date": F.to_date("d"),
        "day_1_date": F.to_date(F.lit("2026-02-02")),
        "day_1_prediction": F.col("p"),
        "day_1_signal": tiers.signal(F.col("p")),
        "day_1_probability": F.col("q"),
        "day_1_confidence": F.col("c"),
    }
    return base.select(
        *(
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.forecast_wide().fields
        )
    )


@pytest.mark.parametrize(
    ("percent", "dashboard", "daily", "week"),
    [
        (40.0, "BEARISH", "SIDEWAYS", "DOWN"),
        (39.9, "BEARISH", "DOWNTREND", "DOWN"),
        (45.0, "BEARISH", "SIDEWAYS", "SIDEWAYS"),
        (50.0, "NEUTRAL", "SIDEWAYS", "SIDEWAYS"),
        (55.0, "BULLISH", "SIDEWAYS", "SIDEWAYS"),
        (60.0, "BULLISH", "SIDEWAYS", "UP"),
        (60.1, "BULLISH", "UPTREND", "UP"),
    ],
)
def test_sentiment_edges(spark, percent, dashboard, daily, week):
    p = F.lit(percent)
    got = spark.range(1).select(
        tiers.DASHBOARD.of(p).alias("a"), tiers.REPORT.of(p).alias("b"), tiers.WEEK.of(p).alias("c")
    )
    assert tuple(got.first()) == (dashboard, daily, week)


def test_stale_tickers_leave_global_questions_only(spark):
    data = make_wide(
        spark,
        [("AAA", "2026-01-30", 1, 0.9, "HIGH"), ("OLD", "2026-01-02", 1, 0.95, "HIGH")],
    )
    assert [r.ticker for r in serving.top_buy(data).collect()] == ["AAA"]
    assert serving.next_single(data, "old").first().probability == 0.95
    assert serving.sync_status(data).first().total_predicted_tickers == 2


def test_ties_rank_by_ticker(spark):
    data = make_wide(spark, [(t, "2026-01-30", 0, 0.2, "HIGH") for t in ("CCC", "AAA", "BBB")])
    assert [r.ticker for r in serving.top_sell(data, 2).collect()] == ["AAA", "BBB"]
    assert [(r["rank"], r.ticker) for r in report.day1_top(data, 2).collect()] == [(1, "AAA"), (2, "BBB")]


def test_minimum_tier(spark):
    data = make_wide(
        spark, [(t, "2026-01-30", 1, 0.6, t) for t in ("LOW", "MEDIUM", "HIGH")]
    )
    for minimum, expected in (("LOW", 3), ("MEDIUM", 2), ("HIGH", 1)):
        assert serving.top_buy(data, 10, minimum).count() == expected
        assert serving.min_tier_set(data, minimum).count() == expected
    with pytest.raises(ValueError):
        serving.top_buy(data, 10, "NONE")
    with pytest.raises(ValueError):
        serving.top_buy(data, 101)


def test_empty_table(spark):
    empty = make_wide(spark, [])
    assert serving.sync_status(empty).first().status == "UNHEALTHY"
    got = serving.market_summary(empty).first()
    assert (got.total_tickers, got.up_percent, got.market_sentiment) == (0, 0.0, "BEARISH")
    assert report.day1_breadth(empty).first().sentiment == "UNKNOWN"


def test_counts_add_up(wide):
    got = serving.market_summary(wide).first()
    assert got.up_count + got.down_count == got.total_tickers
    assert got.high_count + got.medium_count + got.low_count == got.total_tickers
    assert got.up_percent + got.down_percent == pytest.approx(100.0)


@pytest.fixture(scope="module")
def info(spark):
    rows = [("VCB", 10.0, 5.0), ("vnm", 30.0, 4.0), ("A_C", 20.0, 3.0), ("ABC", 20.0, 9.0)]
    return spark.createDataFrame(rows, schemas.STOCK_INFO)


def test_search_ignores_case_and_takes_wildcards(info):
    names = lambda df: [r.ticker for r in df.collect()]
    assert names(serving.stock_search(info, "VN")) == ["vnm"]
    assert names(serving.stock_search(info, "a_c")) == ["ABC", "A_C"]
    assert names(serving.stock_list(info, 2)) == ["ABC", "A_C"]


def test_sorted_pages(info):
    names = lambda df: [r.ticker for r in df.collect()]
    assert names(serving.stock_page(info, "price")) == ["vnm", "ABC", "A_C", "VCB"]
    assert names(serving.stock_page(info, "price", "asc", 2, 1)) == ["ABC", "A_C"]
    assert names(serving.sorted_then_search(info, "volume", "desc", "a", first=2)) == ["ABC"]
    assert names(serving.sorted_then_search(info, "volume", "desc", " ", first=2)) == ["ABC", "VCB"]
    assert serving.stock_count(info).first().total == 4
    for bad in (("size", "desc"), ("price", "up")):
        with pytest.raises(ValueError):
            serving.stock_page(info, *bad)


def test_watch_lists(spark, wide):
    some = [r.ticker for r in serving.as_of_global(wide).limit(3).collect()]
    text = " , ".join(name.lower() for name in some)
    by_text = serving.next_batch(wide, text)
    table = spark.createDataFrame([(f" {name} ",) for name in some], "ticker string")
    assert by_text.exceptAll(serving.next_batch(wide, table)).isEmpty()
    assert by_text.count() == len(some)


def test_forecast_of_one_ticker(wide):
    name = wide.first().ticker
    days = serving.forecast_single(wide, name).orderBy("day").collect()
    assert [d.day for d in days] == list(range(1, 16))
    assert serving.forecast_single(wide, "nobody").count() == 0


def test_prediction_helpers(spark):
    rows = [
        ("2026-01-09", "AAA", "2026-01-09", "2026-01-12", 1, "UP", 0.75, "HIGH"),
        ("2026-01-12", "AAA", "2026-01-12", "2026-01-13", 0, "DOWN", 0.20, "HIGH"),
        ("2026-01-12", "BBB", "2026-01-12", "2026-01-13", 1, "UP", 0.55, "LOW"),
    ]
    names = schemas.NEXT_SESSION.fieldNames()
    text = spark.createDataFrame(rows, names)
    preds = text.select(*(F.col(f.name).cast(f.dataType) for f in schemas.NEXT_SESSION.fields))
    newest = predictions.latest(preds)
    assert newest.count() == 2
    got = predictions.summary(newest).first()
    assert (got.total, got.up, got.down, got.up_percent, got.high_percent) == (2, 1, 1, 50.0, 50.0)
    assert predictions.top_down(newest).first().probability == pytest.approx(0.8)
    assert predictions.history(preds, "2026-01-12", 2).count() == 2
    assert predictions.history(preds, "2026-01-12", 30, "AAA").count() == 2
    assert predictions.summary(newest.limit(0)).first().up_percent == 0.0


def test_freshness_labels(spark):
    raw = spark.createDataFrame([("2026-01-09(2)", "AAA", 1.0, 1.0, 1.0, 1.0, 1.0)], schemas.RAW_BARS)
    labels = [
        report.data_freshness(raw, day).first().freshness
        for day in ("2026-01-09", "2026-01-10", "2026-01-11", "2026-01-12")
    ]
    assert labels == ["TODAY", "YESTERDAY", "RECENT", "STALE"]
    assert report.data_freshness(raw.limit(0), "2026-01-09").first().freshness == "UNKNOWN"


def test_recent_tail_is_per_ticker(spark):
    rows = [(f"2026-01-{d:02}", t, float(d)) for t in ("AAA", "BBB") for d in range(1, 9)]
    table = spark.createDataFrame(rows, "date string, ticker string, close double")
    got = report.recent_tail(table, 3).orderBy("ticker", "position").collect()
    assert [(r.ticker, r.value) for r in got] == [
        (t, float(d)) for t in ("AAA", "BBB") for d in (6, 7, 8)
    ]
