"""JSON Lines, Parquet and lake readers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.text import jvm_trim
from rollcall.operators.processor import accepted, check, storage_spec
from rollcall.operators.runs import concatenate
from rollcall.schemas import (
    FILE_RECORDS,
    LAKE,
    LAKE_BATCH,
    LAKE_FOLDERS,
    LEGACY_LAKE,
    ORIGIN,
    PERSON_EVENT,
    PERSON_FIELDS,
    PERSON_RECORD,
    REPORT,
    RUN_LOG_JSON,
    UNREADABLE,
)
from rollcall.sinks import storage
from rollcall.sinks.compaction import TARGET_BYTES, compact, live_rows, plan, recover
from rollcall.sinks.files import batch_markers
from rollcall.sources.evolution import reconciled, stored_schemas

DATA_FILES = "*.parquet"
# One root folder or several.
Lake = str | Sequence[str]
FILE_LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
    ]
)


def _roots(lake: Lake) -> Sequence[str]:
    return [lake] if isinstance(lake, str) else lake


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 text, one record a line; lines of blanks and control characters are dropped."""
    return spark.read.text(path).filter(jvm_trim(F.col("value")) != "")


def read_people(spark: SparkSession, path: str) -> DataFrame:
    """Parquet person rows, checked again on the way in; rows that fail are left out."""
    spec = storage_spec()
    return accepted(check(read_records(spark, path), spec), spec)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Parquet person rows as stored, for readers that report what fails."""
    return spark.read.schema(PERSON_RECORD).parquet(path).select(*PERSON_FIELDS)


def _level(name: str) -> Column:
    """The value of a folder level in ``path``; null for files outside such folders."""
    return F.nullif(F.regexp_extract("path", rf"/{name}=([^/]+)/", 1), F.lit("")).alias(name)


def _hours(dt_from: str | None, dt_to: str | None) -> Column:
    bounds = F.lit(True)
    if dt_from is not None:
        bounds = bounds & (F.col("dt") >= dt_from)
    if dt_to is not None:
        bounds = bounds & (F.col("dt") <= dt_to)
    return bounds


def read_lake(
    spark: SparkSession,
    lake: Lake,
    dt_from: str | None = None,
    dt_to: str | None = None,
    extra: T.StructType | None = None,
    batches: bool = False,
    merge_schema: bool = False,
) -> DataFrame:
    """The event lake: one root, or several read as one table.

    Bounds are inclusive dates and prune directories.  ``extra`` names columns that newer
    files carry.  Files written before a column existed read as null there, which is what a
    merged schema gives, without opening every footer first; ``merge_schema`` finds the new
    columns by itself, from the footers of one file a batch.  With ``batches`` the name of the
    batch that wrote a row comes along.  Folders of a compaction in progress, or replaced by
    one, are left out.
    """
    if merge_schema:
        extra = added_columns(spark, lake)
    schema = T.StructType(LAKE.fields + (extra.fields if extra else []))
    stored = T.StructType([*schema.fields, T.StructField(ORIGIN, T.StringType()), LAKE_FOLDERS[LAKE_BATCH]])
    names = schema.names + [LAKE_BATCH] * batches

    def rows(root: str) -> DataFrame:
        found = live_rows(spark, root, lambda: spark.read.schema(stored).parquet(root))
        return found.withColumn(LAKE_BATCH, F.coalesce(ORIGIN, LAKE_BATCH)).select(*names)

    return concatenate(*map(rows, _roots(lake))).filter(_hours(dt_from, dt_to))


def added_columns(spark: SparkSession, lake: Lake) -> T.StructType:
    """Columns beyond the lake's own that files of any batch carry, as wide as the widest.

    A batch is written by one job with one schema, so one file of each is looked at.  Columns
    whose types do not fit raise `SchemaClash`; the lake's own columns must keep their types.
    """
    names = [_level(n) for n in LAKE_FOLDERS.names]
    listed = list_data_files(spark, lake).select("path", *names)
    chosen = listed.groupBy(F.coalesce(LAKE_BATCH, F.concat_ws("/", "dt", "hour"))).agg(F.min("path").alias("path"))
    paths = sorted(r["path"] for r in chosen.select("path").collect())  # one for each batch
    found = reconciled([*stored_schemas(spark, paths), (PERSON_EVENT, "the lake's own schema")])
    known = {n.lower() for n in (*LAKE.names, ORIGIN, LAKE_BATCH)}
    return T.StructType([f for f in found.fields if f.name.lower() not in known])


def compact_lake(spark: SparkSession, lake: str, target_bytes: int = TARGET_BYTES, clean: bool = True) -> int:
    """Pack small batches of each hour into files of about ``target_bytes``; returns the folders deleted.

    Batches that may be written again are left alone.  ``clean`` also deletes what was replaced;
    leave it to a later `recover` where readers are at work.
    """
    if clean:
        recover(spark, lake)
    kept = spark.createDataFrame([(n,) for n in storage.files(spark, batch_markers(lake))], f"{LAKE_BATCH} string")
    listed = list_data_files(spark, lake).select("length", *[_level(n) for n in LAKE_FOLDERS.names])
    chosen = plan(listed.join(kept, LAKE_BATCH, "left_anti"), target_bytes)
    stored = T.StructType([*LAKE.fields, T.StructField(ORIGIN, T.StringType()), LAKE_FOLDERS[LAKE_BATCH]])
    rows = live_rows(spark, lake, lambda: spark.read.schema(stored).parquet(lake))
    run = compact(spark, lake, rows, chosen)
    return recover(spark, lake) if run and clean else 0


def read_legacy_lake(
    spark: SparkSession, path: str, dt_from: str | None = None, dt_to: str | None = None
) -> DataFrame:
    """Person rows below dt only, from before the hour level and event times."""
    return spark.read.schema(LEGACY_LAKE).parquet(path).filter(_hours(dt_from, dt_to))


def _or_empty(
    spark: SparkSession, read: Callable[[str], DataFrame], root: str, schema: T.StructType
) -> DataFrame:
    """Run a reader; an absent root gives no rows."""
    try:
        return read(root)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def day_folders(spark: SparkSession, root: str, dt_from: str | None, dt_to: str | None) -> list[str]:
    """Folders dt=... within inclusive bounds, at any depth below the root.

    Only folders above the level of days are listed, so the work does not grow with files.
    """
    found = []
    for name in storage.folders(spark, root):
        day = name.removeprefix("dt=")
        if day == name:
            found += day_folders(spark, f"{root}/{name}", dt_from, dt_to)
        elif (dt_from is None or day >= dt_from) and (dt_to is None or day <= dt_to):
            found.append(f"{root}/{name}")
    return found


def scan_data_files(
    spark: SparkSession,
    lake: Lake,
    extra: T.StructType | None = None,
    dt_from: str | None = None,
    dt_to: str | None = None,
) -> DataFrame:
    """Every Parquet file below the roots as one table, whatever its depth or columns.

    A recursive read finds no partition columns, so dt and hour come from the
    path; they are null for files outside such folders.  With bounds (inclusive dates) only the
    folders of these days are listed and read, and files outside such folders are left out.
    """
    bounded = dt_from is not None or dt_to is not None
    columns = T.StructType(PERSON_EVENT.fields + (extra.fields if extra else []))

    def scan(root: str) -> DataFrame:
        files = spark.read.schema(columns).option("recursiveFileLookup", True).option("pathGlobFilter", DATA_FILES)

        paths = day_folders(spark, root, dt_from, dt_to) if bounded else [root]
        if not paths:
            return spark.createDataFrame([], schema)

        def read() -> DataFrame:
            found = files.parquet(*paths).select(*columns.names, F.col("_metadata.file_path").alias("path"))
            return found.select("*", *[_level(n) for n in LAKE_FOLDERS.names])

        return live_rows(spark, root, read).select(*schema.names)

    levels = T.StructType(LAKE.fields[len(PERSON_EVENT.fields) :])
    schema = T.StructType(columns.fields + levels.fields + [T.StructField("path", T.StringType())])
    return concatenate(*[_or_empty(spark, scan, root, schema) for root in _roots(lake)])


def list_data_files(spark: SparkSession, lake: Lake) -> DataFrame:
    """Path, size and modification time of every data file; contents are not read."""

    def listing(root: str) -> DataFrame:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)

        def read() -> DataFrame:
            # The path is taken as `scan_data_files` takes it, so that the two can be joined.
            found = files.option("pathGlobFilter", DATA_FILES).load(root).select(
                F.col("_metadata.file_path").alias("path"),
                F.col("_metadata.file_modification_time").alias("modificationTime"),
                F.col("_metadata.file_size").alias("length"),
            )
            return found.select("*", *[_level(n) for n in LAKE_FOLDERS.names])

        return live_rows(spark, root, read).select(*FILE_LISTING.names)

    return concatenate(*[_or_empty(spark, listing, root, FILE_LISTING) for root in _roots(lake)])


def read_file_records(spark: SparkSession, path: str) -> DataFrame:
    """What earlier refreshes have counted; an absent table has no rows."""
    return _or_empty(spark, lambda p: spark.read.schema(FILE_RECORDS).parquet(p), path, FILE_RECORDS).select(*FILE_RECORDS.names)


def readable_by_file(scanned: DataFrame) -> DataFrame:
    """Rows per file that pass the record rules."""
    good = accepted(check(scanned, storage_spec()), storage_spec())
    return good.groupBy("path").agg(F.count(F.lit(1)).alias("records"))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The report document, pretty-printed or on one line."""
    return spark.read.schema(REPORT).option("multiLine", True).json(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """All report documents below a path, whatever their depth, one row each with its `source`.

    A document that cannot be read is a row too, with its text in `_unreadable`.
    """
    schema = T.StructType([*REPORT.fields, T.StructField(UNREADABLE, T.StringType())])
    documents = spark.read.schema(schema).option("columnNameOfCorruptRecord", UNREADABLE)
    found = documents.option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return found.select(F.col("_metadata.file_path").alias("source"), *schema.names)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Task runs stored as JSON documents, one row each, times as timestamps."""
    log = spark.read.schema(RUN_LOG_JSON).option("multiLine", True).json(path)
    return log.select(
        F.col("taskId").alias("task_id"),
        "status",
        F.try_to_timestamp("startTime").alias("start_time"),
        F.try_to_timestamp("endTime").alias("end_time"),
        "duration",
        F.col("recordsProcessed").alias("records_processed"),
        F.col("recordsFailed").alias("records_failed"),
        "logs",
        F.col("taskData").alias("task_data"),
        F.col("sampleData").alias("sample_data"),
        "error",
    )
