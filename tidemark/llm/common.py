"""What the text operators share: reading, writing and walking over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import store

# Bytes of text that one step inside a task works on at a time.
STEP_BYTES = 2 << 20
# Rows that go to Python at a time: texts are long, and buffers lie outside the heap.
BATCH_ROWS = 500
# Most rows of ids that are sent to all executors; more are joined by shuffling.
BROADCAST_IDS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back.

    Later steps start from the files, so a lost executor costs its tasks only.
    """
    spark = df.sparkSession
    path = store.new_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Removes tables that ``written`` made, once no step to come reads them."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._written)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame) -> DataFrame:
    """The same columns under numbers, which no name of an operator clashes with."""
    return df.toDF(*(f"c{place}" for place in range(len(df.columns))))


def mapped(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH_ROWS`` rows."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def steps(
    batches: Iterator[pa.RecordBatch], column: int, size: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``size`` bytes in a text or binary column."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
        start = total = 0
        for row, length in enumerate(lengths):
            total += int(length)
            if total >= size:
                yield batch.slice(start, row + 1 - start)
                start, total = row + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def bounded(ids: DataFrame) -> DataFrame:
    """Rows of ids to be broadcast if there are few enough; shuffled otherwise."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
