import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scoring
from tidemark.operators import forecast, latest, metrics, models
from tidemark.plans import published
from tidemark.sources import sample, store


def scored(spark, rows):
    return spark.createDataFrame(rows, "target int, prediction int, probability double")


def brute_auc(rows):
    ups = [p for t, _, p in rows if t == 1]
    downs = [p for t, _, p in rows if t == 0]
    wins = sum((u > d) + 0.5 * (u == d) for u in ups for d in downs)
    return wins / (len(ups) * len(downs))


@pytest.mark.parametrize("seed", range(3))
def test_auc_equals_pair_counting(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(300):
        p = round(rng.choice([rng.random(), 0.5, 0.5000000001, 1.0, 0.0]), 9)
        rows.append((int(rng.random() < 0.3 + 0.4 * p), int(p > 0.5), p))
    data = scored(spark, rows)
    for bits in (7, 16, 21):
        assert metrics.auc(data, digit_bits=bits).first().auc == pytest.approx(brute_auc(rows))


def test_auc_of_scores_close_together(spark):
    rng = random.Random(9)
    rows = [(int(rng.random() < 0.5), 1, 0.5 + rng.random() * 1e-4) for _ in range(400)] + [(0, 0, 0.0), (1, 1, 1.0)]
    for bits in (11, 21):
        assert metrics.auc(scored(spark, rows), digit_bits=bits).first().auc == pytest.approx(brute_auc(rows))


def test_auc_of_adversarial_scores(spark):
    """Neighbouring doubles, numbers without a leading bit, both zeros, signs and infinities."""
    rng = random.Random(10)
    near = [0.5]
    for _ in range(40):
        near.append(math.nextafter(near[-1], 1.0))
    pool = [*near, 0.0, -0.0, 5e-324, 1e-323, 2.2250738585072014e-308, 2.225073858507201e-308, -5e-324, -1.5, 1e300,
            float("inf"), float("-inf"), 1.0, 0.1, 0.2, 0.30000000000000004, 0.3]
    rows = [(int(rng.random() < 0.5), 1, rng.choice(pool)) for _ in range(600)]
    assert metrics.auc(scored(spark, rows)).first().auc == pytest.approx(brute_auc(rows), abs=1e-15)


def test_bits_keep_the_order(spark):
    values = sorted({0.0, 1.0, -1.0, 0.5, math.nextafter(0.5, 0), 5e-324, -5e-324, 1e-310, 1e308, float("inf"), float("-inf"), -2.5, 3.0})
    data = spark.createDataFrame([(v,) for v in [*values, float("nan")]], "p double")
    got = [r.b for r in data.select("p", metrics.ordered_bits(F.col("p")).alias("b")).orderBy("p").collect()]
    assert got == sorted(got) and len(set(got)) == len(got)


def test_auc_by_key_and_undefined(spark):
    data = spark.createDataFrame(
        [("a", 1, 1, 0.9), ("a", 0, 0, 0.1), ("b", 1, 1, 0.9), ("b", 1, 1, 0.8)],
        "model string, target int, prediction int, probability double",
    )
    got = {r.model: r for r in metrics.evaluate(data, ["model"]).collect()}
    assert got["a"].auc == 1.0 and got["b"].auc is None
    assert got["b"].accuracy == 1.0


def test_f1_of_the_rising_class(spark):
    rows = [(1, 1, 0.9), (1, 0, 0.2), (0, 1, 0.8), (0, 0, 0.1), (0, 0, 0.3)]
    assert metrics.f1(scored(spark, rows)).first().f1 == pytest.approx(0.5)
    none = [(0, 0, 0.1), (0, 0, 0.2)]
    assert metrics.f1(scored(spark, none)).first().f1 == 0.0


def test_time_split_cuts_between_days(spark):
    days = [f"2026-01-{d:02}" for d in range(1, 11) for _ in range(3)]
    data = spark.createDataFrame([(d, 1) for d in days] + [("2026-02-01", None)], "d string, target int")
    folds = metrics.time_split(data.withColumn("d", F.to_date("d")), F.col("d"))
    counts = {r.fold: (r["n"], r.lo, r.hi) for r in folds.groupBy("fold").agg(
        F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi")).collect()}
    assert counts["train"][0] == 24 and counts["test"][0] == 6
    assert counts["train"][2] < counts["test"][1]


def runs(spark, rows):
    full = [(r, m, 0.5, 0.4, auc, day) for r, m, auc, day in rows]
    return spark.createDataFrame(full, "run_id string, model string, accuracy double, f1 double, auc double, saved_at string").withColumn(
        "saved_at", F.to_date("saved_at")
    )


def test_champion_gate_promotes_only_strict_gains(spark):
    gate = metrics.champion_gate(
        runs(
            spark,
            [
                ("r1", "a", 0.60, "2026-01-01"),
                ("r2", "a", 0.60, "2026-01-02"),
                ("r3", "a", 0.65, "2026-01-03"),
                ("r4", "a", 0.61, "2026-01-04"),
            ],
        )
    ).orderBy("run_no").collect()
    assert [g.promoted for g in gate] == [True, False, True, False]
    assert [g.previous_champion for g in gate] == [None, "r1", "r1", "r3"]
    assert gate[2].auc_change == pytest.approx(0.05)


def test_run_without_auc_is_never_promoted(spark):
    rows = [("r0", "a", None, "2026-01-01"), ("r1", "a", 0.7, "2026-01-02"), ("r2", "a", None, "2026-01-03"), ("r3", "a", 0.65, "2026-01-04")]
    gate = metrics.champion_gate(runs(spark, rows))
    got = gate.orderBy("run_no").collect()
    assert [g.promoted for g in got] == [False, True, False, False]
    assert [g.previous_champion for g in got] == [None, None, "r1", "r1"]
    assert metrics.champion(gate).first().run_id == "r1"


def test_champion_is_the_last_promoted(spark):
    gate = metrics.champion_gate(runs(spark, [("r1", "a", 0.7, "2026-01-01"), ("r2", "a", 0.6, "2026-01-02")]))
    assert metrics.champion(gate).first().run_id == "r1"


def test_leaderboard_marks_one_best(spark):
    board = metrics.leaderboard(
        runs(spark, [("r1", "lr", 0.50369267, "2026-01-01"), ("r2", "rf", 0.45134008, "2026-01-01")])
    ).collect()
    assert {(b.model, b.auc, b.is_best) for b in board} == {("lr", 0.5037, True), ("rf", 0.4513, False)}


@pytest.fixture(scope="module")
def planted(spark):
    """Rows whose class follows two of the features, with noise."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        x = [rng.gauss(0, 1) for _ in schemas.FEATURES]
        up = int(x[0] - 0.7 * x[13] + rng.gauss(0, 0.5) > 0)
        rows.append((f"2026-{1 + i // 60:02}-01", f"T{i % 60}", up, *x, 1.0))
    return spark.createDataFrame(rows, schemas.FEATURE_TABLE).cache()


def test_models_find_a_planted_signal(spark, planted):
    fits = {
        "gbt": models.fit_gbt(planted, trees=5),
        "forest": models.fit_forest(planted, trees=5, depth=5),
        "logistic": models.fit_logistic(planted, 100),
    }
    for name, model in fits.items():
        got = metrics.evaluate(models.score(model, planted)).first()
        assert got.auc > 0.75, name
        assert got.accuracy > 0.65, name
    again = models.fit_gbt(planted, trees=5)
    a = models.score(fits["gbt"], planted).select("ticker", "date", "probability")
    b = models.score(again, planted).select("ticker", "date", "probability")
    assert a.exceptAll(b).isEmpty()
    top = models.feature_importance(spark, fits["gbt"]).orderBy("rank").collect()
    assert {t.feature for t in top[:2]} == {"return_1d", "close_position"}
    assert len(top) == 3


def test_compiled_logistic_equals_the_model_path(spark, planted):
    model = models.fit_logistic(planted, 50)
    newest = planted.filter("date = '2026-10-01'").withColumn("latest_data_date", F.to_date("date"))
    slow = forecast.to_long(forecast.forecast(model, newest, "2026-10-01", days=4))
    fast = forecast.to_long(forecast.forecast(models.compiled(model), newest, "2026-10-01", days=4))
    key = lambda r: (r.ticker, r.day)
    for a, b in zip(sorted(slow.collect(), key=key), sorted(fast.collect(), key=key), strict=True):
        assert (a.ticker, a.day, a.date, a.prediction, a.confidence) == (b.ticker, b.day, b.date, b.prediction, b.confidence)
        assert a.probability == pytest.approx(b.probability, abs=1e-8)


def test_saved_model_scores_alike(spark, planted, path):
    model = models.fit_gbt(planted, trees=3)
    target = path("model")
    models.save_model(model, target)
    back = models.score(models.load_model(target), planted).select("probability")
    assert back.exceptAll(models.score(model, planted).select("probability")).isEmpty()


def test_align_features(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0, 9.0)], "ticker string, b double, a double, extra double")
    got = models.align_features(df, ["a", "b", "c"], keep=["ticker"])
    assert got.columns == ["ticker", "a", "b", "c"] and tuple(got.first()) == ("A", 2.0, 1.0, 0.0)
    cut = models.align_by_position(df.drop("ticker"), 2)
    assert cut.columns == ["b", "a"]
    filled = models.align_by_position(df.drop("ticker"), 5)
    assert filled.columns == ["b", "a", "extra", "feat_3", "feat_4"]


def test_one_forecast_step(spark):
    values = {name: float(i) for i, name in enumerate(schemas.SCALED)}
    for prediction, s in ((1, 1.0), (0, -1.0)):
        df = spark.createDataFrame(
            [("A", prediction, *values.values())],
            "ticker string, prediction int, " + ", ".join(f"{c} double" for c in schemas.SCALED),
        )
        got = forecast.rollforward_step(df).first()
        x = {name: values[f"{name}_scaled"] for name in schemas.FEATURES}
        expected = x | {
            "return_1d": 0.8 * s,
            "return_3d": x["return_3d"] * 0.8 + 0.4 * s,
            "return_5d": x["return_5d"] * 0.8 + 0.3 * s,
            "return_10d": x["return_10d"] * 0.8 + 0.2 * s,
            "price_vs_ma5": x["price_vs_ma5"] + 0.15 * s,
            "price_vs_ma10": x["price_vs_ma10"] + 0.10 * s,
            "ma5_vs_ma10": x["ma5_vs_ma10"] + 0.05 * s,
            "oc_return": 0.5 * s,
            "close_position": 0.8 * s,
            "return_lag1": x["return_1d"],
            "return_lag2": x["return_lag1"],
            "return_lag3": x["return_lag2"],
        }
        for name, value in expected.items():
            assert got[f"{name}_scaled"] == pytest.approx(value), name


def test_forecast_bounds_and_round_trip(spark, planted):
    newest = planted.filter("date = '2026-10-01'").withColumn("latest_data_date", F.to_date("date"))
    entries = forecast.forecast(sample.BLEND, newest, "2026-10-02")
    long = forecast.to_long(entries)
    for r in long.collect():
        k = max(0.3, 1 - 0.05 * (r.day - 1))
        assert 0.5 - k / 2 - 1e-9 <= r.probability <= 0.5 + k / 2 + 1e-9
        assert r.prediction == int(r.probability > 0.5)
        assert r.signal == ("UP" if r.prediction else "DOWN")
    wide = forecast.to_wide(entries)
    assert wide.columns == schemas.forecast_wide().fieldNames() and len(wide.columns) == 77
    assert forecast.pivot_wide(long).exceptAll(wide).isEmpty()
    assert forecast.unpivot(wide).exceptAll(long).isEmpty()
    assert long.exceptAll(forecast.unpivot(wide)).isEmpty()
    missing = wide.withColumn("day_15_date", F.lit(None).cast("date"))
    assert forecast.unpivot(missing).count() == long.count() - wide.count()


@pytest.fixture(scope="module")
def labelled(spark):
    table = published.read(spark, "/root/testdata/sf0.001", "features")
    return table.filter("target is not null")


FITS = {
    "gbt": lambda rows: models.fit_gbt(rows, trees=12),
    "forest": lambda rows: models.fit_forest(rows, trees=9, depth=7),
    "logistic": lambda rows: models.fit_logistic(rows, 20),
}


@pytest.mark.parametrize("kind", list(FITS))
def test_compiled_models_score_like_fitted_ones(spark, labelled, kind):
    """Probability, class and forecast of a model and of its column expression agree."""
    store.ensure_checkpoint_dir(spark)
    model = FITS[kind](labelled)
    packed = models.compiled(model)
    assert isinstance(packed, (scoring.LinearScorer, scoring.TreeScorer))
    own = models.score(model, labelled).select("ticker", "date", F.col("probability").alias("p"))
    both = models.score(packed, labelled).join(own, ["ticker", "date"])
    assert both.filter(F.abs(F.col("p") - F.col("probability")) > 1e-12).isEmpty()
    assert both.count() == labelled.count()
    newest = latest.latest_features(labelled)
    a, b = (forecast.forecast(m, newest, "2024-01-31") for m in (model, packed))
    rows = [sorted((r.ticker, [(e.day, e.prediction, round(e.probability, 9), e.confidence) for e in r.entries]) for r in f.collect()) for f in (a, b)]
    assert rows[0] == rows[1]
    # All days of all rows are one projection over the scan.
    one = forecast.forecast(packed, labelled.withColumn("latest_data_date", F.current_date()), "2024-01-31")
    nodes = [line.strip("+- *()0123456789").split(" ")[0] for line in one._jdf.queryExecution().executedPlan().treeString().splitlines()]
    assert [n for n in nodes if n] == ["Project", "Filter", "ColumnarToRow", "FileScan"], nodes


def test_tree_of_one_leaf(spark):
    """A model that never splits is its leaf."""
    store.ensure_checkpoint_dir(spark)
    rows = [(None, "T", i % 2, *[0.0] * len(schemas.SCALED), 1.0) for i in range(20)]
    data = spark.createDataFrame(rows, schemas.FEATURE_TABLE)
    packed = models.compiled(models.fit_forest(data, trees=3, depth=2))
    assert packed.depth == 0
    assert models.score(packed, data).first().probability == pytest.approx(0.5, abs=0.3)


def test_training_rows_come_in_even_parts(spark, planted):
    """Also where the table lies in one file; the rows themselves stay the same."""
    wanted = spark.sparkContext.defaultParallelism
    rows = models._labelled(planted.coalesce(1))
    sizes = rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == wanted and max(sizes) - min(sizes) <= 1
    assert sum(sizes) == planted.filter("target is not null").count()


def test_forest_keeps_the_nodes_of_its_rows(spark, planted):
    """Which leaves the trees as they are."""
    kept = models.fit_forest(planted, trees=4, depth=6)
    walked = models._columns(
        models.RandomForestClassifier(numTrees=4, maxDepth=6, seed=42)
    ).fit(models._labelled(planted))
    assert kept.getCacheNodeIds() and not walked.getCacheNodeIds()
    assert kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_trees_roll_on_all_cores(spark, planted):
    newest = latest.latest_features(planted.coalesce(1))
    packed = models.compiled(models.fit_gbt(planted, trees=2, depth=2))
    entries = forecast.forecast(packed, newest, "2026-10-01", days=2)
    assert entries.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
