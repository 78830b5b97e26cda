"""Event-log writers.  Messages are (key, value) rows, whatever carries them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall.config import event_log_write_options

# Sends a batch of (key, value); says why each was refused, or None.
Sender = Callable[[Sequence[tuple[str, str]]], Sequence[str | None]]
OpenSender = Callable[[], Sender]
UNSENDABLE = "No key or no value"


@dataclass(frozen=True)
class PublishCounts:
    success: int
    failure: int


def _sendable() -> Column:
    return F.col("key").isNotNull() & F.col("value").isNotNull()


def _publish(messages: DataFrame, write: Callable[[DataFrame], None]) -> PublishCounts:
    """Send the messages that have a key and a value; count both kinds in the same pass.

    A message the broker refuses fails its task, which Spark retries: the
    failures counted here are messages that cannot be sent at all.
    """
    seen = Observation()
    success, failure = F.count_if(_sendable()), F.count_if(~_sendable())
    counted = messages.observe(seen, success.alias("success"), failure.alias("failure"))
    write(counted.filter(_sendable()))
    return PublishCounts(seen.get["success"], seen.get["failure"])


def publish_topic(messages: DataFrame, **options: str) -> PublishCounts:
    settings = event_log_write_options(**options)
    return _publish(messages, lambda m: m.write.format("kafka").options(**settings).save())


def publish_staged(messages: DataFrame, path: str) -> PublishCounts:
    """Append the messages to a folder that `stream_staged_messages` reads."""
    return _publish(messages, lambda m: m.write.mode("append").parquet(path))


def publish_acknowledged(messages: DataFrame, open_sender: OpenSender, path: str) -> PublishCounts:
    """Send the messages batch by batch, and write the outcome of each to a table.

    ``open_sender`` is called once a task and gives a function that sends a batch of (key, value)
    and returns why each was refused, or None for one the log has acknowledged.  The table has
    key, value and `error`, and a message without a key or a value is refused before it is sent.  A
    task that is run again sends its messages again, as any producer does after a lost answer, but
    the table and the counts hold one outcome of each message: that of the attempt whose rows were
    committed.  Nothing stops at a refusal.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deliver = open_sender()
        for batch in batches:
            errors = np.array([UNSENDABLE] * batch.num_rows, object)
            whole = pc.and_(pc.is_valid(batch["key"]), pc.is_valid(batch["value"]))
            ready = batch.filter(whole)
            if ready.num_rows:
                answers = deliver(list(zip(ready["key"].to_pylist(), ready["value"].to_pylist(), strict=True)))
                if len(answers) != ready.num_rows:
                    raise ValueError(f"{ready.num_rows} messages sent, {len(answers)} answers")
                errors[whole.to_numpy(zero_copy_only=False)] = answers
            columns = [batch["key"], batch["value"], pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "value", "error"])

    texts = messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
    seen, delivered = Observation(), F.col("error").isNull()
    outcomes = texts.mapInArrow(send, "key string, value string, error string")
    outcomes = outcomes.observe(seen, F.count_if(delivered).alias("success"), F.count_if(~delivered).alias("failure"))
    outcomes.write.mode("append").parquet(path)
    return PublishCounts(seen.get["success"], seen.get["failure"])


def publish_topic_stream(messages: DataFrame, checkpoint: str, **options: str) -> StreamingQuery:
    """Publish a stream of messages; the checkpoint carries its progress."""
    writer = messages.filter(_sendable()).writeStream.format("kafka")
    writer = writer.options(**event_log_write_options(**options))
    return writer.option("checkpointLocation", checkpoint).start()
