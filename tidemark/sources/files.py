"""Reading and writing the datasets of the library."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import dates
from tidemark.operators import ingest
from tidemark.sources import months
from tidemark.sources.months import MONTH, NO_MONTH

log = logging.getLogger(__name__)


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    columns = schemas.RAW_BARS.fieldNames()
    return spark.read.schema(schemas.RAW_BARS).parquet(path).select(*columns)


def scan_features(spark: SparkSession, path: str) -> DataFrame:
    columns = schemas.FEATURE_TABLE.fieldNames()
    return spark.read.schema(schemas.FEATURE_TABLE).parquet(path).select(*columns)


def scan_drift_union(
    spark: SparkSession, paths: Sequence[str], skipped: list[str] | None = None
) -> DataFrame:
    """Union datasets whose schemas have drifted apart.

    A path is a folder of files with one schema; paths of equal schemas are read
    together, so the plan has a branch per schema. ``date`` becomes text, missing
    columns become NULL, number types widen. A path that does not exist raises. Paths
    whose files have no readable schema are left out, logged and put into ``skipped``;
    unreadable files beside readable ones raise when they are read.
    """
    alike: dict[str, list[str]] = {}
    for path in paths:
        try:
            alike.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise
            _leave_out(path, error, skipped)
        except Exception as error:  # noqa: BLE001 - a broken footer is no analysis error
            if "FAILED_READ_FILE" not in str(error) and "CANNOT_READ_FILE_FOOTER" not in str(error):
                raise
            _leave_out(path, error, skipped)
    merged: DataFrame | None = None
    for schema, group in alike.items():
        part = spark.read.schema(schemas.T.StructType.fromJson(json.loads(schema))).parquet(*group)
        if "date" in part.columns:
            part = part.withColumn("date", F.col("date").cast("string"))
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    if merged is None:
        raise FileNotFoundError(f"no readable parquet data in {', '.join(paths)}")
    return merged


def _leave_out(path: str, error: Exception, skipped: list[str] | None) -> None:
    log.warning("left out %s: %s", path, str(error).splitlines()[0])
    if skipped is not None:
        skipped.append(path)


def save_features(table: DataFrame, path: str, moved: bool = True) -> None:
    """Replace the feature dataset; it lies in monthly folders. See ``months.write`` for ``moved``."""
    rows = table.select(*schemas.FEATURE_TABLE.fieldNames())
    rows = rows.withColumn(MONTH, months.month_of(F.col("date")))
    months.write(rows, path, ["ticker", "date"], whole=True, moved=moved)


def save_feature_months(table: DataFrame, path: str) -> None:
    """Replace the months at hand of the feature dataset; the table may be made from it."""
    rows = table.select(*schemas.FEATURE_TABLE.fieldNames())
    months.write(rows.withColumn(MONTH, months.month_of(F.col("date"))), path, ["ticker", "date"])


def _with_month(raw: DataFrame) -> DataFrame:
    return raw.withColumn(MONTH, months.month_of(F.col("date")))


def save_raw(raw: DataFrame, path: str) -> None:
    """Write raw bars in monthly folders, replacing only the months at hand."""
    rows = raw.select(*schemas.RAW_BARS.fieldNames())
    months.write(_with_month(rows), path, ["ticker", "date"])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a dataset lies there."""
    try:
        spark.read.schema(schemas.RAW_BARS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def raw_state(spark: SparkSession, path: str) -> DataFrame:
    """One row: does the dataset exist, has it rows, and its newest date; from the facts."""
    return raw_facts(spark, path).agg(
        F.lit(exists(spark, path)).alias("exists"),
        (F.coalesce(F.sum("rows"), F.lit(0)) > 0).alias("has_rows"),
        F.max("newest_date").alias("last_date"),
    )


def raw_facts(spark: SparkSession, path: str, before: list | None = None) -> DataFrame:
    """What is known of each month and ticker of the raw bars."""
    return months.facts(spark, path, schemas.RAW_BARS, before)


def touched_raw(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """The stored bars of the months that new bars touch."""
    columns = schemas.RAW_BARS.fieldNames()
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.RAW_BARS)
    # One row per calendar month and one for the rest, some kilobytes for centuries: it
    # prunes the folders read.
    touched = F.broadcast(_with_month(new).select(MONTH).distinct())
    return scan_raw_months(spark, path).join(touched, MONTH, "left_semi").select(*columns)


def merge_raw(
    spark: SparkSession, path: str, new: DataFrame, arrival: Sequence[str] = ()
) -> None:
    """Upsert new bars into the raw dataset; untouched months are not read.

    The first merge creates the dataset. ``arrival`` names columns of the new bars in
    whose order rows of one key arrived; the last one stays. Rows without a readable
    date have a folder of their own. Dynamic partition overwrite writes beside the old
    files and swaps the touched months at commit, so the job may read the dataset it
    replaces.
    """
    columns = schemas.RAW_BARS.fieldNames()
    before = months.states(spark, path)
    new = new.select(*columns, *arrival)
    stored = touched_raw(spark, path, new)
    stored = stored.select(*columns, *(F.lit(None).alias(name) for name in arrival))
    save_raw(ingest.upsert_keep_last(stored, new, arrival=arrival), path)
    # The facts of the months just written; the others stay.
    raw_facts(spark, path, before)


def recent_raw(spark: SparkSession, path: str, days: int) -> DataFrame:
    """Raw bars of the months that reach ``days`` back from the newest month on.

    Only those folders are read; rows without a readable date are left out. A dataset
    without monthly folders is read whole.
    """
    stored = scan_raw_months(spark, path)
    columns = schemas.RAW_BARS.fieldNames()
    # Folder names alone answer this; no file is opened for a column.
    newest = stored.filter(F.col(MONTH) != NO_MONTH).agg(F.max(MONTH)).first()[0]
    if newest is None:
        return stored.select(*columns)
    oldest = F.substring(F.date_sub(F.lit(f"{newest}-01").cast("date"), days).cast("string"), 1, 7)
    return stored.filter((F.col(MONTH) >= oldest) & (F.col(MONTH) != NO_MONTH)).select(*columns)


def scan_raw_months(spark: SparkSession, path: str) -> DataFrame:
    return months.scan(spark, path, schemas.RAW_BARS)


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table."""
    writer = df.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def save_predictions(preds: DataFrame, path: str) -> None:
    """One folder per target date; a rerun replaces only its own dates."""
    (
        preds.hint("rebalance", F.col("predicted_for_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("predicted_for_date")
        .parquet(path)
    )


def scan_predictions(spark: SparkSession, path: str) -> DataFrame:
    columns = schemas.NEXT_SESSION.fieldNames()
    return spark.read.schema(schemas.NEXT_SESSION).parquet(path).select(*columns)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def scan_price_volume_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PRICE_VOLUME_CSV).csv(path, header=True)


def scan_signal_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SIGNAL_CSV).csv(path, header=True)


def save_metrics(runs: DataFrame, path: str) -> None:
    """Append runs as JSON documents; ``params`` (a map) and ``train_seconds`` if they are there."""
    params = F.create_map(F.lit("model"), F.col("model"))
    if "params" in runs.columns:
        params = F.map_concat(F.coalesce("params", F.create_map().cast("map<string,string>")), params)
    seconds = F.col("train_seconds") if "train_seconds" in runs.columns else F.lit(None)
    runs.select(
        F.struct(
            "accuracy", F.col("f1").alias("f1_score"), F.col("auc").alias("auc_roc")
        ).alias("metrics"),
        F.struct(
            "run_id",
            F.col("model").alias("experiment_id"),
            params.alias("params"),
            seconds.cast("double").alias("train_seconds"),
        ).alias("model_info"),
        F.col("saved_at").cast("string").alias("saved_at"),
    ).write.mode("append").json(path)


def scan_metrics(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Stored runs; ``multi_line`` for files that hold one indented document each."""
    documents = spark.read.schema(schemas.METRICS_JSON).json(path, multiLine=multi_line)
    return documents.select(
        F.col("model_info.run_id").alias("run_id"),
        F.col("model_info.experiment_id").alias("model"),
        F.col("metrics.accuracy").alias("accuracy"),
        F.col("metrics.f1_score").alias("f1"),
        F.col("metrics.auc_roc").alias("auc"),
        F.col("saved_at").try_cast("timestamp_ntz").alias("saved_at"),
        F.col("model_info.params").alias("params"),
        F.col("model_info.train_seconds").alias("train_seconds"),
    )


def publish(df: DataFrame, path: str) -> str:
    """Write a version of a table beside the others, then point to it.

    Readers of ``published`` see the old version until the pointer is there.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex[:12]
    df.write.parquet(f"{path}/versions/{version}")
    pointer = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("since"))
    pointer.coalesce(1).write.mode("append").parquet(f"{path}/pointer")
    return version


def published(spark: SparkSession, path: str, schema: schemas.T.StructType) -> DataFrame:
    """The newest version that ``publish`` wrote."""
    pointer = spark.read.schema("version string, since timestamp").parquet(f"{path}/pointer")
    newest = pointer.agg(F.max_by("version", F.struct("since", "version"))).first()[0]
    return spark.read.schema(schema).parquet(f"{path}/versions/{newest}")


def table_version(spark: SparkSession, path: str) -> str | None:
    """A token that changes when files of the dataset change; None if unreadable.

    Only file listings are read: the file contents are pruned away.
    """
    try:
        files = spark.read.format("binaryFile").options(
            pathGlobFilter="*.parquet", recursiveFileLookup="true"
        ).load(path)
    except AnalysisException:
        return None
    row = files.agg(
        F.count("*").alias("n"),
        F.unix_micros(F.max("modificationTime")).alias("newest"),
        F.sum("length").alias("bytes"),
    ).first()
    return f"{row['n']}-{row['newest']}-{row['bytes']}" if row["n"] else None


def snapshot_sync(
    spark: SparkSession, source: str, target: str, state: str
) -> DataFrame:
    """Copy ``source`` to ``target`` if its version changed; report what was done.

    An unknown version always copies; an empty or missing source never does, and the
    target stays as it was. ``state`` holds the version of the last copy.
    """
    version = table_version(spark, source)
    last = None
    if exists(spark, state):
        stored = spark.read.schema("version string").parquet(state).first()
        last = stored["version"] if stored else None
    if version is None:
        action = "empty_source"
    elif version == last:
        action = "up_to_date"
    else:
        data = spark.read.parquet(source)
        if data.isEmpty():
            action = "empty_source"
        else:
            data.write.mode("overwrite").parquet(target)
            spark.createDataFrame([(version,)], "version string").write.mode(
                "overwrite"
            ).parquet(state)
            action = "copied"
    return spark.createDataFrame(
        [(source, target, version, action)],
        "source string, target string, version string, action string",
    )


_FOLDERS = "folder string, state string, version string"


def _folder_states(spark: SparkSession, source: str) -> DataFrame | None:
    """Partition folders of a dataset with the state of their files, from listings alone.

    ``root`` is the dataset's full path, ``folder`` what is below it, empty without partitions.
    """
    try:
        found = spark.read.format("binaryFile").options(
            pathGlobFilter="*.parquet", recursiveFileLookup="true"
        ).load(source)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    below = r"((?:/[^/=]+=[^/]*)*)/[^/]+$"
    file = F.concat_ws(":", F.regexp_extract("path", "[^/]+$", 0), "length", F.unix_micros("modificationTime"))
    return found.groupBy(
        F.regexp_replace("path", below, "").alias("root"),
        F.ltrim(F.regexp_extract("path", below, 1), F.lit("/")).alias("folder"),
    ).agg(F.sha2(F.concat_ws(",", F.sort_array(F.collect_list(file))), 256).alias("state"))


def mirror(spark: SparkSession, source: str, target: str) -> dict[str, int]:
    """Bring a served copy up to date: folders whose files have changed are copied, no others.

    A folder's state is the names, lengths and times of its files. Changed folders are written as a new
    version beside what is served, then a new list of folders is published by a pointer, so
    readers see all of one state or all of the next. An empty or missing source changes nothing.
    Returns how many folders were copied, kept and dropped.
    """
    states = _folder_states(spark, source)
    held = spark.createDataFrame([], _FOLDERS)
    if exists(spark, f"{target}/list/pointer"):
        held = published(spark, f"{target}/list", schemas.T.StructType.fromDDL(_FOLDERS))
    nothing = {"copied": 0, "kept": held.count(), "dropped": 0}
    if states is None or states.isEmpty() or spark.read.parquet(source).isEmpty():
        return nothing
    states = states.withColumn("version", F.lit(None).cast("string"))
    kept = held.join(states.select("folder", "state"), ["folder", "state"], "left_semi")
    changed = states.join(kept, ["folder", "state"], "left_anti")
    # One entry per folder of the dataset, as the driver lists them to read it.
    todo = changed.agg(F.sort_array(F.collect_list(F.struct("folder", "root", "state")))).first()[0]
    dropped = held.join(states, "folder", "left_anti").count()
    if not todo and not dropped:
        return nothing
    version = uuid.uuid4().hex[:12]
    if todo:
        schema = spark.read.parquet(source).schema
        rows = spark.read.schema(schema).option("basePath", todo[0]["root"]).parquet(
            *(f"{t['root']}/{t['folder']}".rstrip("/") for t in todo)
        )
        keys = [part.split("=")[0] for part in todo[0]["folder"].split("/") if part]
        if keys:
            rows = rows.hint("rebalance", *(F.col(key) for key in keys))
        rows.write.partitionBy(*keys).parquet(f"{target}/versions/{_VERSION}={version}")
    new = spark.createDataFrame([(t["folder"], t["state"], version) for t in todo], _FOLDERS)
    publish(kept.select("folder", "state", "version").unionByName(new).coalesce(1), f"{target}/list")
    return {"copied": len(todo), "kept": kept.count(), "dropped": dropped}


_VERSION = "_version"


def mirrored(spark: SparkSession, target: str, schema: schemas.T.StructType) -> DataFrame:
    """The served copy as the newest list names it."""
    folders = published(spark, f"{target}/list", schemas.T.StructType.fromDDL(_FOLDERS))
    path = F.concat_ws("/", F.concat(F.lit(f"{target}/versions/{_VERSION}="), "version"), F.nullif("folder", F.lit("")))
    paths = folders.agg(F.sort_array(F.collect_list(path))).first()[0]
    full = schemas.T.StructType([*schema.fields, schemas.T.StructField(_VERSION, schemas.T.StringType())])
    rows = spark.read.schema(full).option("basePath", f"{target}/versions").parquet(*paths)
    return rows.select(*schema.fieldNames())
