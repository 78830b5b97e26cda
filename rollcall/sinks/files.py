"""JSON Lines, Parquet, lake and report writers."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.functions.codec import to_json_text
from rollcall.operators.city_state import city_parts
from rollcall.operators.events import partition_keys
from rollcall.operators.people import to_storage
from rollcall.operators.processor import ERROR
from rollcall.operators.quality import ProcessingStats, outcome_counts
from rollcall.schemas import LAKE_BATCH, PARTITION_KEYS, PERSON_FIELDS, REPORT_FIGURE
from rollcall.sinks import storage

OUTCOME = "outcome"
ACCEPTED, REJECTED = "accepted", "rejected"
# The section of a report that holds its time and total.
HEADER = "report"


def write_json_lines(df: DataFrame, path: str, *fields: str) -> None:
    """One JSON object a line, replacing what is there."""
    df.select(to_json_text(fields or df.columns).alias("value")).write.mode("overwrite").text(path)


def write_people(people: DataFrame, path: str) -> None:
    to_storage(people).write.mode("overwrite").parquet(path)


def write_statistics(stats: DataFrame, path: str) -> None:
    stats.write.mode("overwrite").parquet(path)


@dataclass(frozen=True)
class SplitWrite:
    """Where a split write put its rows, and what it counted on the way."""

    accepted: str
    rejected: str
    stats: ProcessingStats
    schema: StructType

    def read(self, spark: SparkSession, side: str) -> DataFrame:
        """The rows of one side; a side that got no row is an empty table."""
        path = self.accepted if side == ACCEPTED else self.rejected
        try:
            return spark.read.schema(self.schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.schema)


def write_split(processed: DataFrame, path: str) -> SplitWrite:
    """Write good rows and quarantined rows in a single pass over the input.

    Each outcome gets its own folder, a plain Parquet table.  Counts are taken
    by the write itself, so nothing is read or computed twice.
    """
    seen = Observation()
    outcome = F.when(F.col(ERROR).isNull(), ACCEPTED).otherwise(REJECTED)
    rows = processed.observe(seen, *outcome_counts()).withColumn(OUTCOME, outcome)
    rows.write.mode("overwrite").partitionBy(OUTCOME).parquet(path)
    return SplitWrite(
        f"{path}/{OUTCOME}={ACCEPTED}",
        f"{path}/{OUTCOME}={REJECTED}",
        ProcessingStats.observed(seen),
        processed.schema,
    )


def batch_markers(lake: str) -> str:
    """Folder of one empty file for each batch that may be written again."""
    return f"{lake}/_batches"


def settle_batch(spark: SparkSession, lake: str, batch: str) -> None:
    """Say that a batch will not be written again; from now on compaction may take it."""
    storage.delete(spark, f"{batch_markers(lake)}/{batch}")


def append_to_lake(events: DataFrame, path: str, batch: str, speed_view: str | None = None) -> None:
    """Put events under dt/hour/batch; a batch that is written again replaces only itself.

    The first time a batch is written its rows are appended, which costs one rename a file; only
    a batch with a marker, which an earlier try has left, overwrites its own folders.
    Rebalancing groups each hour's rows into few files, and AQE splits an hour that is too big
    for one task, however large its share of the rows.  With ``speed_view`` the parts of the
    batch's city statistics go there.
    """
    first = storage.mark(events.sparkSession, f"{batch_markers(path)}/{batch}")
    _write_batch(events, path, batch, first)
    if speed_view is not None:
        keyed = partition_keys(events).withColumn(LAKE_BATCH, F.lit(batch))
        replace_batch(city_parts(keyed), speed_view, LAKE_BATCH)


def _write_batch(events: DataFrame, path: str, batch: str, first: bool) -> None:
    keyed = partition_keys(events).withColumn(LAKE_BATCH, F.lit(batch)).hint("rebalance", *PARTITION_KEYS)
    if first:
        keyed.write.mode("append").partitionBy(*PARTITION_KEYS, LAKE_BATCH).parquet(path)
    else:
        replace_batch(keyed, path, *PARTITION_KEYS, LAKE_BATCH)


def replace_batch(df: DataFrame, path: str, *keys: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def write_lake(events: DataFrame, path: str, batch: str | None = None) -> None:
    """Append events to the lake as a batch of their own.

    A caller that may repeat the write names the batch, which then replaces itself.
    """
    if batch is None:
        _write_batch(events, path, f"write-{uuid.uuid4().hex}", first=True)
    else:
        append_to_lake(events, path, batch)


def land_batch(
    people: DataFrame, path: str, run_millis: Column | None = None, batch: str | None = None
) -> None:
    """Append a batch of people to the lake under the hour of the run."""
    millis = F.unix_millis(F.current_timestamp()) if run_millis is None else run_millis
    landed = people.select(*PERSON_FIELDS, millis.alias("eventTime"))
    write_lake(landed, path, batch)


def write_report(report: DataFrame, path: str, generated_at: Column | None = None) -> None:
    """Write the figures as JSON Lines, a folder for each section, replacing what is there.

    The first section holds one row: when the report was made, as its key, and the total.
    The format is the same at every size, and no task holds more than its share of figures.
    """
    if generated_at is None:
        generated_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    total = F.col("section") == "total"
    figures = report.withColumns(
        {
            "key": F.when(total, generated_at).otherwise(F.col("key")),
            "section": F.when(total, F.lit(HEADER)).otherwise(F.col("section")),
        }
    )
    figures.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("section").json(path)


def read_report_figures(spark: SparkSession, path: str) -> DataFrame:
    """The figures of a written report; those of its header have the time of the report as key."""
    return spark.read.schema(REPORT_FIGURE).json(path)
