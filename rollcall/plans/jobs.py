"""The platform's jobs, each a short chain of library calls."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollcall.config import scratch_dir
from rollcall.functions.rules import normal_values
from rollcall.operators.city_state import city_parts, merged_parts, statistics_of_parts
from rollcall.operators.events import encode_events, to_events
from rollcall.operators.people import enrich, some_enriched
from rollcall.operators.processor import (
    ERROR,
    RULE,
    accepted,
    business_spec,
    check,
    parse_people,
    process,
    storage_spec,
)
from rollcall.operators.quality import MINIMUM_RATE, processing_stats, validate_lake
from rollcall.operators.runs import lake_inventory, run_history
from rollcall.operators.statistics import batch_profile, city_statistics, combined_report
from rollcall.schemas import CITY_PARTS, FILE_RECORDS, LAKE_BATCH, LAKE_FOLDERS, PERSON_FIELDS
from rollcall.sinks import storage
from rollcall.sinks.event_log import PublishCounts
from rollcall.sinks.files import (
    SplitWrite,
    land_batch,
    replace_batch,
    write_json_lines,
    write_report,
    write_split,
    write_statistics,
)
from rollcall.sources.files import (
    Lake,
    list_data_files,
    read_file_records,
    read_json_lines,
    read_lake,
    readable_by_file,
    scan_data_files,
)
from rollcall.sources.generator import (
    DEFAULT_FILE_ROWS,
    DEFAULT_LANDING_ROWS,
    DEFAULT_TOPIC_ROWS,
    generate_people,
)

# What tells a file apart from one that replaced it.
FILE_KEY = ("path", "modificationTime", "length")
# Files whose records one step of the history counts.
HISTORY_FILES = 10_000


def process_lines(lines: DataFrame) -> DataFrame:
    """Parse, check the business rules and normalise, as one projection.

    Good rows carry normalised values; bad rows keep theirs, and the line.
    """
    done = normal_values() | {"value": F.lit(None).cast("string")}
    return process(lines, replace(business_spec(), transforms=done, parse=parse_people))


def preprocess(
    spark: SparkSession, source: str, target: str, minimum_rate: float | None = MINIMUM_RATE
) -> SplitWrite:
    """JSON Lines to Parquet: one pass writes people and quarantine, and counts both.

    Raises when fewer than `minimum_rate` percent of the lines are good; the
    output is kept for inspection.
    """
    written = write_split(process_lines(read_json_lines(spark, source)), target)
    if minimum_rate is not None:
        written.stats.require(minimum_rate)
    return written


def check_lines(spark: SparkSession, source: str, *order_by: str) -> DataFrame:
    """Statistics of a JSON Lines input; nothing is written."""
    return processing_stats(process_lines(read_json_lines(spark, source)), *order_by)


def messages_from_file(
    spark: SparkSession, source: str, event_time: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Messages of a JSON Lines file, and the lines that cannot be decoded.

    Only the decode applies: neither the business rules nor normalising.
    """
    parsed = parse_people(read_json_lines(spark, source))
    people = parsed.filter(F.col(ERROR).isNull())
    dropped = parsed.filter(F.col(ERROR).isNotNull()).select("value", ERROR, RULE)
    return encode_events(to_events(people, event_time)), dropped


def publish_file(
    spark: SparkSession,
    source: str,
    publish: Callable[[DataFrame], PublishCounts],
    event_time: Column | None = None,
) -> tuple[PublishCounts, int]:
    """Publish a JSON Lines file in one pass; returns the counts and the undecodable lines.

    `publish` is a sink function taking messages, such as `publish_topic`.
    """
    seen = Observation()
    parsed = parse_people(read_json_lines(spark, source))
    counted = parsed.observe(seen, F.count_if(F.col(ERROR).isNotNull()).alias("dropped"))
    people = counted.filter(F.col(ERROR).isNull())
    counts = publish(encode_events(to_events(people, event_time)))
    return counts, seen.get["dropped"]


def write_generated_lines(spark: SparkSession, target: str, rows: int = DEFAULT_FILE_ROWS) -> None:
    """Generated people as JSON Lines, replacing what is there."""
    write_json_lines(generate_people(spark, rows), target, *PERSON_FIELDS)


def publish_generated(
    spark: SparkSession, publish: Callable[[DataFrame], PublishCounts], rows: int = DEFAULT_TOPIC_ROWS
) -> PublishCounts:
    """Generated people as events of this moment."""
    return publish(encode_events(to_events(generate_people(spark, rows))))


def batch_analytics(spark: SparkSession, lake: Lake, target: str) -> tuple[int, DataFrame]:
    """City statistics of the lake to Parquet; returns the row count and an enriched sample.

    The row count is the sum over the written cities, so the lake is not scanned
    for it, and a stage that is run again cannot count twice.
    """
    write_statistics(city_statistics(read_lake(spark, lake)), target)
    counted = spark.read.parquet(target).agg(F.coalesce(F.sum("total_people"), F.lit(0)))
    return counted.first()[0], some_enriched(read_lake(spark, lake))


def enriched_lake(spark: SparkSession, lake: Lake) -> DataFrame:
    return enrich(read_lake(spark, lake))


def refresh_batch_view(
    spark: SparkSession, lake: str, view: str, dt_from: str | None = None, dt_to: str | None = None
) -> None:
    """Recompute the parts of city statistics of the given days from the lake; other days stay.

    Days are replaced whole, so the job can be repeated.
    """
    parts = city_parts(read_lake(spark, lake, dt_from, dt_to, batches=True))
    replace_batch(parts.hint("rebalance", "dt"), view, "dt")


def lambda_parts(spark: SparkSession, view: str, speed_view: str) -> DataFrame:
    """Parts of the batch view, and of the speed view where the batch view has not caught up."""
    views = [spark.read.schema(CITY_PARTS).parquet(path).select(*CITY_PARTS.names) for path in (view, speed_view)]
    return merged_parts(*views)


def lambda_statistics(spark: SparkSession, view: str, speed_view: str) -> DataFrame:
    """City statistics over all events so far, without reading the events."""
    merged = statistics_of_parts(lambda_parts(spark, view, speed_view))
    return merged.orderBy(F.desc("total_people"), "city")


def trim_speed_view(spark: SparkSession, view: str, speed_view: str) -> int:
    """Delete the speed view's batches that the batch view holds in every hour; returns their number."""
    batch, speed = (
        spark.read.schema(CITY_PARTS).parquet(path).select(*LAKE_FOLDERS.names).distinct() for path in (view, speed_view)
    )
    missing = speed.join(batch, LAKE_FOLDERS.names, "left_anti").select(LAKE_BATCH)
    held = speed.select(LAKE_BATCH).distinct().join(missing, LAKE_BATCH, "left_anti")
    names = [r[0] for r in held.toLocalIterator()]
    return sum(storage.delete(spark, f"{speed_view}/{LAKE_BATCH}={name}") for name in names)


def generate(
    spark: SparkSession,
    lake: str,
    rows: int = DEFAULT_LANDING_ROWS,
    run_millis: Column | None = None,
) -> DataFrame:
    """Land a batch of generated people in the lake; returns its profile."""
    people = generate_people(spark, rows)
    land_batch(people, lake, run_millis)
    return batch_profile(people)


def validate(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """File inventory and row validation of everything below the lake root."""
    return (
        lake_inventory(list_data_files(spark, lake)),
        validate_lake(scan_data_files(spark, lake)),
    )


def analyze(
    spark: SparkSession, lake: Lake, target: str, generated_at: Column | None = None
) -> None:
    """Report over the readable rows of the lake."""
    write_report(combined_report(readable_people(spark, lake)), target, generated_at)


def readable_people(spark: SparkSession, lake: Lake) -> DataFrame:
    spec = storage_spec()
    return accepted(check(scan_data_files(spark, lake), spec), spec).select(*PERSON_FIELDS)


def export_history(spark: SparkSession, lake: Lake) -> DataFrame:
    """Records, running total and size of every file, oldest first."""
    counts = readable_by_file(scan_data_files(spark, lake))
    return run_history(counts, list_data_files(spark, lake))


def refresh_history(spark: SparkSession, lake: Lake, store: str, most_files: int = HISTORY_FILES) -> int:
    """Count the records of files that the store does not know; returns how many files were read.

    A file is known by path, time and size, so one that was replaced is read again, and one that
    shows up late, with a time before files already known, is not missed.  The oldest files go
    first, at most ``most_files`` in one step, and each step's counts appear whole or not at all:
    a run that dies is taken up again where it stopped.
    """
    known = list_data_files(spark, lake).join(read_file_records(spark, store), list(FILE_KEY), "left_anti")
    listed = known.withColumn("_at", F.unix_micros("modificationTime"))
    path = scratch_dir(spark, "new-files")
    listed.write.mode("overwrite").parquet(path)
    fresh = spark.read.schema(listed.schema).parquet(path)
    left, read = fresh, 0
    while step := left.select("_at", "path").orderBy("_at", "path").limit(most_files).collect():
        last = F.struct(F.lit(step[-1]["_at"]).cast("bigint"), F.lit(step[-1]["path"]))
        place = F.struct("_at", "path")
        # The condition on the path picks files before any is opened.
        counts = readable_by_file(scan_data_files(spark, lake).filter(F.col("path").isin([r["path"] for r in step])))
        counted = left.filter(place <= last).join(counts, "path", "left")
        counted = counted.withColumn("records", F.coalesce("records", F.lit(0)).cast("bigint"))
        counted.select(*FILE_RECORDS.names).coalesce(1).write.mode("append").parquet(store)
        read += len(step)
        left = fresh.filter(place > last)
    return read


def read_history(spark: SparkSession, lake: Lake, store: str) -> DataFrame:
    """`export_history` of the lake from the stored counts; no file is opened.

    Files that are gone, after a compaction say, are left out; those not counted yet have no
    records until the next refresh.
    """
    listed = list_data_files(spark, lake)
    counts = read_file_records(spark, store).dropDuplicates(list(FILE_KEY)).join(listed, list(FILE_KEY), "left_semi")
    return run_history(counts.select("path", "records"), listed)
