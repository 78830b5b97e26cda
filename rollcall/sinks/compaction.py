"""Compaction of the lake: many small batches of an hour become few files of a target size.

Batches smaller than the target are packed into bins, hour by hour, and each bin is written as
one batch.  Rows keep the name of the batch that wrote them, in ``origin``.  A run goes through

1. announced: the log names the run; its folders are not read yet,
2. written: its folders stand in the lake, still not read,
3. committed: one file appears in the log that names the batches it replaces; from here on
   readers take the run's folders and leave the replaced ones,
4. cleaned: the replaced folders are deleted, then the log's entries.

Readers compare the log before and after they list the lake, so they see a run whole or not at
all, and a run that dies at any step is finished or undone by `recover`.  The log holds runs in
progress alone and is gone when none is.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.schemas import COMPACTION_LOG, LAKE_BATCH, ORIGIN, PARTITION_KEYS
from rollcall.sinks import storage

#: Bytes that a compacted file aims at.
TARGET_BYTES = 128 << 20
PREFIX = "compact-"
ANNOUNCED, COMMITTED = "announced", "committed"
FOLDER = (*PARTITION_KEYS, LAKE_BATCH)


def log_path(lake: str) -> str:
    return f"{lake}/_compaction"


def read_log(spark: SparkSession, lake: str) -> DataFrame | None:
    """(run, state, dt, hour, batch) of runs in progress, or None."""
    try:
        return spark.read.schema(COMPACTION_LOG).option("recursiveFileLookup", True).parquet(log_path(lake))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _states(log: DataFrame | None) -> dict[str, str]:
    """The state of each run in progress."""
    if log is None:
        return {}
    latest = log.groupBy("run").agg(F.max("state").alias("state"))  # committed sorts after announced
    return {r["run"]: r["state"] for r in latest.collect()}


def _write_log(spark: SparkSession, lake: str, run: str, rows: DataFrame, state: str) -> None:
    """One file, which appears whole or not at all."""
    entry = rows.select(F.lit(run).alias("run"), F.lit(state).alias("state"), *FOLDER)
    entry.coalesce(1).write.mode("overwrite").parquet(f"{log_path(lake)}/{run}/{state}")


def live_rows(spark: SparkSession, lake: str, read) -> DataFrame:
    """What ``read()`` gives (with dt, hour and batch) without the folders that a run in progress hides.

    ``read`` lists the lake; it is called again if a run went a step further meanwhile.
    """
    while True:
        log = read_log(spark, lake)
        before = _states(log)
        rows = read()
        if before == _states(read_log(spark, lake)):
            break
    if not before:
        return rows
    for run, state in before.items():
        if state == ANNOUNCED:
            rows = rows.where(~F.coalesce(F.col(LAKE_BATCH), F.lit("")).startswith(f"{run}-"))
    replaced = log.where(F.col("state") == COMMITTED).select(*FOLDER).distinct()
    return rows.join(replaced, list(FOLDER), "left_anti")


def plan(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(dt, hour, batch, bin) of the batches worth packing, from a listing with dt, hour, batch and length.

    Small batches of an hour are taken in name order and dealt to bins by their running size; a
    bin takes less than twice the target.  Bins of a single batch are left as they are.
    """
    sizes = files.where(F.col(LAKE_BATCH).isNotNull()).groupBy(*FOLDER).agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))
    hour = Window.partitionBy(*PARTITION_KEYS)
    upto = F.sum("bytes").over(hour.orderBy(LAKE_BATCH)) - F.col("bytes")
    small = sizes.where(F.col("bytes") < target_bytes).withColumn("bin", F.floor(upto / target_bytes))
    of_bin = Window.partitionBy(*PARTITION_KEYS, "bin")  # an hour's folders, not its rows
    packed = small.withColumn("_files", F.sum("files").over(of_bin)).withColumn("_batches", F.count("*").over(of_bin))
    return packed.where((F.col("_files") > 1) & (F.col("_batches") > 1)).select(*FOLDER, "bin")


def compact(spark: SparkSession, lake: str, rows: DataFrame, chosen: DataFrame) -> str | None:
    """Write the chosen batches anew and commit; returns the run, or None if there is nothing to do.

    ``rows`` are the lake's rows with dt, hour, batch and origin; ``chosen`` comes from `plan`.
    Each bin is one task and one file.
    """
    run = f"{PREFIX}{uuid.uuid4().hex}"
    path = f"{log_path(lake)}/{run}/_chosen"
    chosen.write.parquet(path)
    chosen = spark.read.schema(chosen.schema).parquet(path)
    if not chosen.limit(1).count():
        _forget(spark, lake, run)
        return None
    nothing = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in FOLDER])
    _write_log(spark, lake, run, nothing, ANNOUNCED)
    packed = rows.join(chosen, list(FOLDER)).withColumn(ORIGIN, F.coalesce(ORIGIN, LAKE_BATCH))
    named = packed.withColumn(LAKE_BATCH, F.concat(F.lit(f"{run}-"), F.col("bin").cast("string"))).drop("bin")
    dealt = named.repartition(*FOLDER)
    dealt.write.mode("append").partitionBy(*FOLDER).parquet(lake)
    _write_log(spark, lake, run, chosen, COMMITTED)
    return run


def _forget(spark: SparkSession, lake: str, run: str) -> None:
    storage.delete(spark, f"{log_path(lake)}/{run}")
    if not storage.folders(spark, log_path(lake)):
        storage.delete(spark, log_path(lake))


def recover(spark: SparkSession, lake: str) -> int:
    """Finish what runs left: committed ones lose the folders they replaced, others their own.

    Returns the number of folders deleted.  To be called when no compaction is at work and
    readers that began before a commit have ended.  The driver deletes the
    folders one by one; their names come to it in parts.
    """
    log = read_log(spark, lake)
    deleted = 0
    states = _states(log)
    for run in storage.folders(spark, log_path(lake)):
        if states.get(run) == COMMITTED:
            gone = log.where((F.col("run") == run) & (F.col("state") == COMMITTED)).select(*FOLDER).distinct()
            folders = (f"{lake}/dt={r['dt']}/hour={r['hour']}/{LAKE_BATCH}={r[LAKE_BATCH]}" for r in gone.toLocalIterator())
        else:
            folders = _own_folders(spark, lake, run)
        deleted += sum(storage.delete(spark, folder) for folder in folders)
        _forget(spark, lake, run)
    return deleted


def _own_folders(spark: SparkSession, lake: str, run: str):
    for dt in storage.folders(spark, lake):
        for hour in storage.folders(spark, f"{lake}/{dt}"):
            for batch in storage.folders(spark, f"{lake}/{dt}/{hour}"):
                if batch.startswith(f"{LAKE_BATCH}={run}-"):
                    yield f"{lake}/{dt}/{hour}/{batch}"
