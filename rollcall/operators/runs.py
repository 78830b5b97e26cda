"""Figures about the lake's files and about task runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.config import scratch_dir
from rollcall.schemas import RUN_STATES


def lake_inventory(files: DataFrame) -> DataFrame:
    """Number of files, total bytes and whole kilobytes, from a file listing."""
    size = F.coalesce(F.sum("length"), F.lit(0))
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        size.alias("total_bytes"),
        F.floor(size / 1024).cast("bigint").alias("size_kb"),
    )


def running_total(
    df: DataFrame, value: str, name: str, order_by: tuple[str, ...], partitions: int
) -> DataFrame:
    """Exact running total without sorting all rows in one task.

    Rows are range-partitioned by the order and pinned in a table in the shared
    folder, because partition numbers must not move when a task is retried.
    Each partition then sums on its own and adds the total of those before it.
    """
    parts = df.repartitionByRange(partitions, *order_by)
    pinned = parts.withColumn("_part", F.spark_partition_id())
    path = scratch_dir(df.sparkSession, "running-total")
    pinned.write.parquet(path)
    pinned = df.sparkSession.read.schema(pinned.schema).parquet(path)
    upto = Window.partitionBy("_part").orderBy(*order_by)
    local = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per range partition: `partitions` rows at most.
    totals = pinned.groupBy("_part").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    return (
        pinned.withColumn(name, F.sum(value).over(local))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col(name) + F.col("_base"))
        .drop("_part", "_base")
    )


def run_history(
    records_by_file: DataFrame, files: DataFrame, partitions: int | None = None
) -> DataFrame:
    """Per file in modification-time order: records, running total and size.

    `records_by_file` has (path, records); `files` is the listing with
    (path, length, modificationTime), so files without readable rows show zero.
    The running total takes as many range partitions as the session shuffles into.
    """
    partitions = partitions or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = files.join(records_by_file, "path", "left").select(
        "path",
        F.col("modificationTime").alias("timestamp"),
        F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
        F.floor(F.col("length") / 1024).cast("bigint").alias("size_kb"),
    )
    summed = running_total(
        runs, "records", "cumulative_total", ("timestamp", "path"), partitions
    )
    return summed.select("path", "timestamp", "records", "cumulative_total", "size_kb")


def run_log_summary(log: DataFrame) -> DataFrame:
    """Totals over run-log rows, with one counter per state."""

    def in_state(state: str) -> Column:
        return F.count_if(F.col("status") == state).alias(state.lower())

    def total(column: str, name: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(name)

    return log.agg(
        F.count(F.lit(1)).alias("total"),
        *[in_state(state) for state in RUN_STATES],
        total("duration", "total_duration"),
        total("records_processed", "total_records"),
        total("records_failed", "total_failed"),
    )


def concatenate(*tables: DataFrame) -> DataFrame:
    """Bag union by column name; columns a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
