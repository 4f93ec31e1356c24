"""Where intermediate and published tables go."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's checkpoint folder.

    Only a local session without that setting falls back to a temporary folder.
    """
    folder = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {_KEY} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tidemark/{app}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Writes in here remove their shuffle files when they end, not when the driver collects garbage."""
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


def staged(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once for the steps that read them again."""
    spark = rows.sparkSession
    path = new_path(spark, name)
    with freed(spark):
        rows.write.parquet(path)
    table = spark.read.schema(rows.schema).parquet(path)
    table._staged = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Removes tables that ``staged`` made, once no step to come reads them."""
    for table in tables:
        removed(table.sparkSession, table._staged)


def removed(spark: SparkSession, path: str) -> None:
    """Removes what lies there, once no step to come reads it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; set one only where there is none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
