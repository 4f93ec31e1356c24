"""The shape of the physical plans."""

import re
from pathlib import Path

import pytest

from tidemark.operators import features, latest, scale, serving
from tidemark.plans import published
from tidemark.plans.catalog import QUERIES
from tidemark.sources import sample

SMALL = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(autouse=True)
def whole_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_features_use_one_exchange_and_sort_by_ticker(spark):
    text = plan(features.feature_rows(sample.bars(spark, SMALL)))
    assert len(re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\)", text)) == 1
    above = text[: text.index("Exchange hashpartitioning")]
    assert above.count("Sort [") == 1 and above.count("Window [") == 2


def test_scaling_reuses_the_exchange(spark):
    rows = features.feature_rows(sample.bars(spark, SMALL))
    assert "ReusedExchange" in final_plan(scale.feature_table(rows))


def test_newest_rows_are_limited_before_the_shuffle(spark):
    text = plan(latest.stock_info(sample.bars(spark, SMALL)))
    assert re.search(r"WindowGroupLimit.*Final", text) and re.search(r"WindowGroupLimit.*Partial", text)


def test_ranked_questions_are_top_k_with_pushed_filters(spark):
    wide = published.read(spark, SMALL, "wide")
    text = plan(serving.top_buy(wide))
    assert "TakeOrderedAndProject" in text
    assert "EqualTo(day_1_prediction,1)" in text
    assert "day_2_" not in text
    page = plan(serving.stock_page(published.read(spark, SMALL, "info"), "price", "desc", 5, 5))
    assert "TakeOrderedAndProject" in page


def test_unpivot_does_not_shuffle(spark):
    assert "Exchange" not in plan(QUERIES["forecast_long"](spark, SMALL))


def test_history_reads_one_partition(spark):
    text = plan(QUERIES["pred_latest"](spark, SMALL))
    assert re.search(r"PartitionFilters: \[.*predicted_for_date", text)


SLOW_TO_PLAN = {"daily_job", "gated_job", "preprocess_job", "stream_session_bar"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW_TO_PLAN))
def test_no_python_or_cartesian_nodes(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_sources_avoid_driver_side_work():
    for file in ROOT.joinpath("tidemark").rglob("*.py"):
        if "llm" in file.parts:
            continue
        text = file.read_text()
        for call in (".collect()", "toPandas", "localCheckpoint", "crossJoin", "rdd."):
            assert call not in text, f"{file.name}: {call}"


@pytest.mark.parametrize("grain", ("month", "day"))
def test_bars_sort_their_lines_once_and_behind_the_shuffle(spark, grain):
    """A sort below the exchange would order, and spill, whole input splits."""
    text = plan(sample.bars(spark, SMALL, grain))
    assert text.count("Exchange") == 1 and text.count("+- Sort [") == 1
    assert "Sort" not in text[text.index("Exchange") :]
