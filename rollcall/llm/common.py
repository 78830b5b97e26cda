"""Helpers the corpus operators share: words, staged tables, row numbers and checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.config import scratch_dir

# Fixed value: a word is a run of characters other than space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a staged side up to which it is broadcast; larger sides are joined by shuffle.
BROADCAST_ROWS = 200_000


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores behind, as no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, limit: str = "4m") -> Iterator[None]:
    """Within it, jobs that start hand Python workers batches of at most ``limit`` bytes and one row."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, limit)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a staged table of at most ``rows`` rows; the join is the same either way."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def number_rows(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """Rows with ``row_number`` from 0 in the given order, and their count.

    Rows are range-partitioned and sorted, written once, and counted per partition; the offsets
    are one row per partition.  Rows that tie in every key are told apart by a seeded random
    number, so that a value that a third of all rows share is still spread.
    """
    keys = [*order, F.rand(11)]
    placed = staged(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
        ),
        name,
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.withColumn("row_number", F.col("_before") + F.col("_pos")).drop(
        "_part", "_pos", "_before"
    ), int(total)
