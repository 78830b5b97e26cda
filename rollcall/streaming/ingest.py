"""Event stream to lake.

Event times and partition keys come from the message.  No step after the decode
keeps state or looks at the watermark, so a late event is never dropped: it lands
in the folder of its own hour.  Each batch is written under the id of its query and its own
number, so a batch that is run again replaces itself and nothing else, other queries and
landed batches may share the root, and a new checkpoint starts folders of its own.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rollcall.config import COMMIT_TIMEOUT_SECONDS, TRIGGER_INTERVAL, WATERMARK_DELAY
from rollcall.operators.events import (
    HOUR_PARTS,
    decode_events,
    event_timestamp,
    figures_of_parts,
    hourly_figures,
    hourly_parts,
    quarantine_rows,
)
from rollcall.operators.processor import ERROR, RULE, RecordSpec, accepted, check, storage_spec
from rollcall.schemas import EVENT_FIELDS, LAKE_BATCH
from rollcall.sinks.files import append_to_lake, replace_batch, settle_batch

QUARANTINE = T.StructType([T.StructField(c, T.StringType()) for c in ("value", ERROR, RULE)])
HOURS = T.StructType(
    [T.StructField(c, T.TimestampType()) for c in ("window_start", "window_end")]
    + [T.StructField(c, T.LongType()) for c in HOUR_PARTS]
)

CLOSED_HOURS = T.StructType(
    HOURS.fields[:2]
    + [T.StructField("events", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in ("avg_age", "stddev_age")]
)


def _batch_name(batch: DataFrame, batch_id: int) -> str:
    """The query's id, which stays over restarts and is new with a new checkpoint, and the batch."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def _trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """A fixed interval, or with None: take what is there now, then stop."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


class BatchTimeout(RuntimeError):
    """A micro-batch ran longer than it may; its query has been stopped, nothing of it is committed."""


def run_within(query: StreamingQuery, batch_seconds: float = COMMIT_TIMEOUT_SECONDS, poll_seconds: float = 1.0) -> None:
    """Wait for a query to end, and stop it when one micro-batch takes longer than ``batch_seconds``.

    The time between batches does not count, so a query may wait for messages as long as it likes.  A
    batch that is stopped stays uncommitted in the checkpoint and is run again by the next start.  Its
    tasks are ended; code of the caller's own that blocks the driver can only be waited for.
    A failure of the query is raised as `awaitTermination` does.
    """
    batch, since = None, time.monotonic()
    while not query.awaitTermination(poll_seconds):
        progress = query.lastProgress
        now = (progress["batchId"] if progress else None, query.status["isTriggerActive"])
        if now != batch or not now[1]:
            batch, since = now, time.monotonic()
        elif time.monotonic() - since > batch_seconds:
            query.stop()
            raise BatchTimeout(f"a batch of {query.id} ran longer than {batch_seconds} s")


def with_event_time(decoded: DataFrame) -> DataFrame:
    """Event timestamp and the bounded-lateness watermark."""
    timed = decoded.withColumn("event_ts", event_timestamp(F.col("eventTime")))
    return timed.withWatermark("event_ts", WATERMARK_DELAY)


def ingest_to_lake(
    messages: DataFrame,
    lake: str,
    checkpoint: str,
    quarantine: str | None = None,
    strict: bool = False,
    interval: str | None = TRIGGER_INTERVAL,
    speed_view: str | None = None,
) -> StreamingQuery:
    """Decode messages and append complete events to the lake, exactly once.

    Messages that cannot be decoded go to the quarantine, from the same decode; with
    `strict` the first one fails the query instead.  One of the two must be chosen.
    Each batch's parts of the city statistics go to `speed_view`, if one is named.
    """
    if not strict and quarantine is None:
        raise ValueError("name a quarantine for bad messages, or set strict")
    decoded = decode_events(messages, strict=strict)
    return _ingest(decoded, None, lake, quarantine, checkpoint, interval, speed_view)


def _ingest(
    verdict: DataFrame,
    spec: RecordSpec | None,
    lake: str,
    quarantine: str | None,
    checkpoint: str,
    interval: str | None,
    speed_view: str | None = None,
) -> StreamingQuery:
    """Write good rows to the lake, rebalanced by hour, and bad rows to the quarantine."""

    def write(batch: DataFrame, batch_id: int) -> None:
        name = _batch_name(batch, batch_id)
        rows = batch.persist() if quarantine or speed_view else batch
        try:
            good = accepted(rows, spec) if spec else rows.filter(F.col(ERROR).isNull())
            # A query only ever repeats its last batch.
            settle_batch(batch.sparkSession, lake, _batch_name(batch, batch_id - 1))
            append_to_lake(good.select(*EVENT_FIELDS), lake, name, speed_view)
            if quarantine:
                bad = quarantine_rows(rows).withColumn(LAKE_BATCH, F.lit(name))
                replace_batch(bad, quarantine, LAKE_BATCH)
        finally:
            rows.unpersist()

    writer = verdict.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Messages of the quarantine with their reasons; no message yet is an empty table."""
    return spark.read.schema(QUARANTINE).parquet(path).select(*QUARANTINE.names)


def quarantine_stream(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = TRIGGER_INTERVAL
) -> StreamingQuery:
    """Append undecodable or incomplete messages, with the reason, to their own table."""
    writer = quarantine_rows(decode_events(messages)).writeStream.format("parquet")
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start(path)


def ingest_validated(
    messages: DataFrame,
    lake: str,
    quarantine: str,
    checkpoint: str,
    interval: str | None = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Decode, apply the record rules, and write good and bad rows from one decode.

    A micro-batch that is run again replaces its own folders, so both outputs
    hold every message once.  Events keep their dt/hour place in the lake.
    """
    spec = storage_spec()
    return _ingest(check(decode_events(messages), spec), spec, lake, quarantine, checkpoint, interval)


def hourly_stream(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = TRIGGER_INTERVAL
) -> StreamingQuery:
    """Parts of hourly figures, added batch by batch; `read_hours` sums them.

    Nothing is held back or dropped: an hour shows as soon as it has an event, and a late event
    changes its hour.  Parts are whole numbers, so the sums are exact.
    """
    decoded = decode_events(messages).filter(F.col(ERROR).isNull())
    timed = decoded.withColumn("event_ts", event_timestamp(F.col("eventTime")))

    def write(batch: DataFrame, batch_id: int) -> None:
        parts = hourly_parts(batch).withColumn(LAKE_BATCH, F.lit(_batch_name(batch, batch_id)))
        replace_batch(parts, path, LAKE_BATCH)

    writer = timed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """Hourly figures of all batches so far."""
    return figures_of_parts(spark.read.schema(HOURS).parquet(path).select(*HOURS.names))


def closed_hours_stream(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = TRIGGER_INTERVAL
) -> StreamingQuery:
    """Hourly figures, written once the watermark passes the hour.

    The watermark and the open hours are kept over restarts.  Rows later than that are not in
    these figures; `hourly_stream` counts them, and `late_after_close` says how many they are.
    """
    decoded = decode_events(messages).filter(F.col(ERROR).isNull())
    figures = hourly_figures(with_event_time(decoded))
    writer = figures.writeStream.format("parquet").outputMode("append")
    return _trigger(writer.option("checkpointLocation", checkpoint), interval).start(path)


def read_closed_hours(spark: SparkSession, path: str) -> DataFrame:
    """Hours closed so far; none yet is an empty table."""
    return spark.read.schema(CLOSED_HOURS).parquet(path)
