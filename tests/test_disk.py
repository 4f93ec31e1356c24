"""What jobs leave on disk while they run."""

from __future__ import annotations

import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans import jobs
from tidemark.sources import files, months, store


@pytest.fixture
def raw(spark, path):
    draw = random.Random(5)
    rows = []
    for t in range(6):
        for day in range(90):
            low, high = sorted(10 + 5 * draw.random() for _ in range(2))
            ends = (low + (high - low) * draw.random() for _ in range(2))
            key = f"2025-{1 + day // 28:02}-{1 + day % 28:02}"
            rows.append((key, f"T{t}", next(ends), high, low, next(ends), 5 + draw.random()))
    where = path("raw")
    files.save_raw(spark.createDataFrame(rows, schemas.RAW_BARS), where)
    return where


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = blocks.getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).endswith(".data")}


def test_writes_remove_their_shuffle_files(spark, path):
    rows = spark.range(500).select(F.col("id"), F.lit("2025-01").alias(months.MONTH))
    before = shuffle_files(spark)
    months.write(rows, path("written"), ["id"])
    store.staged(rows.repartition(3, "id"), "staged")
    until = time.monotonic() + 20
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(store._FREE, "false") != "true"


@pytest.mark.parametrize("share", [None, 0.8])
def test_large_tables_stay_in_their_tasks(spark, path, raw, monkeypatch, share):
    """The same rows; between the steps lie bars only, and at the end nothing."""
    made, wide = {}, []
    staged = store.staged

    def watched(rows, name):
        wide.extend({"volatility_5"} & set(rows.columns))
        return staged(rows, name)

    monkeypatch.setattr(store, "staged", watched)
    for moved in (True, False):
        if not moved:
            monkeypatch.setattr(jobs, "TASK_ROWS", 180)
            monkeypatch.setattr(jobs, "UNMOVED_TASKS", 3)
        paths = jobs.Paths.under(path("large"), raw)
        assert jobs.preprocess(spark, paths, train_share=share, digits=6)["rows"] > 400
        made[moved] = files.scan_features(spark, paths.features)
        folders = {}
        for file in Path(paths.features).rglob("*.parquet"):
            folders.setdefault(file.parent.name, []).append(file)
        assert len(folders) == 4 and (max(map(len, folders.values())) > 1) is not moved
    assert made[True].exceptAll(made[False]).isEmpty() and made[False].exceptAll(made[True]).isEmpty()
    assert not wide
    kept = Path(paths.features).parent.parent
    assert not list(kept.glob("bars-*")) and not list(kept.glob("feature-rows-*"))
