"""Boosted trees: the same as Spark ML's, fitted in one stage."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import boosting, models
from tidemark.sources import store


@pytest.fixture(scope="module")
def rows(spark):
    store.ensure_checkpoint_dir(spark)
    rng = random.Random(11)
    made = []
    for i in range(900):
        x = [rng.gauss(0, 1) for _ in schemas.FEATURES]
        up = int(x[1] + 0.6 * x[9] * x[4] + rng.gauss(0, 0.4) > 0)
        made.append((f"2026-{1 + i // 90:02}-01", f"T{i % 90}", up, *x, 1.0))
    return spark.createDataFrame(made, schemas.FEATURE_TABLE).cache()


def classifier(trees, depth=4):
    return models._columns(models.GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.1, seed=42))


@pytest.mark.parametrize("share", [1 << 16, 200])
def test_trees_are_those_of_spark_ml(spark, rows, monkeypatch, share):
    """In one task and in four that add up their sums."""
    monkeypatch.setattr(boosting, "PART_ROWS", share)
    own = boosting.fit(classifier(6), rows, "target", schemas.SCALED)
    theirs = classifier(6).fit(models._labelled(rows))
    assert own.getNumTrees == 6 and own.treeWeights == theirs.treeWeights
    assert own.totalNumNodes == theirs.totalNumNodes
    p = models.score(theirs, rows).select("ticker", "date", F.col("probability").alias("p"))
    both = models.score(own, rows).join(p, ["ticker", "date"])
    assert both.filter(F.abs(F.col("p") - F.col("probability")) < 1e-9).count() == rows.count()
    # In nodes of few rows several features part them alike; rounding picks one.
    assert own.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.02)
    assert {p.name for p in own.extractParamMap()} == {p.name for p in theirs.extractParamMap()}


def test_passes_start_no_jobs(spark, rows, monkeypatch):
    """More trees are more passes in the same tasks."""
    monkeypatch.setattr(boosting, "PART_ROWS", 200)
    sc = spark.sparkContext
    jobs = []
    for trees in (2, 20):
        sc.setJobGroup(f"boosting-{trees}", "fit")
        models.fit_gbt(rows, trees=trees)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"boosting-{trees}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[1] <= jobs[0] + 2


def test_borders_hold_equal_shares():
    assert boosting.borders(np.array([3.0, 1.0, 1.0, 2.0]), 32).tolist() == [1.5, 2.5]
    assert boosting.borders(np.array([5.0, 5.0]), 32).tolist() == []
    found = boosting.borders(np.arange(1000.0), 32)
    assert len(found) == 31 and np.diff(found).min() >= 31 and np.diff(found).max() <= 32


def test_rows_that_cannot_be_learned_from(spark, rows):
    with pytest.raises(ValueError, match="no training rows"):
        models.fit_gbt(rows.filter("false"), trees=1)
    for bad in (
        rows.withColumn(schemas.SCALED[3], F.lit(None).cast("double")),
        rows.withColumn(schemas.SCALED[3], F.lit(float("nan"))),
        rows.withColumn("target", F.lit(2)),
    ):
        with pytest.raises(Exception, match="training rows hold|labels are"):
            models.fit_gbt(bad, trees=1)


def test_spark_ml_fits_where_tasks_cannot_run_at_once(spark, rows, monkeypatch):
    assert boosting._tasks(spark, "hdfs://name/kept") == 1
    assert boosting._tasks(spark, "/kept") == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(boosting, "_tasks", lambda *_: 1)
    monkeypatch.setattr(boosting, "PART_ROWS", 10)
    assert boosting.fit(classifier(1), rows, "target", schemas.SCALED) is None
    assert models.fit_gbt(rows, trees=2).getNumTrees == 2
