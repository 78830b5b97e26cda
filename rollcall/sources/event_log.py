"""Event-log readers: a Kafka topic, or a folder of staged messages with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.config import event_log_read_options
from rollcall.schemas import EVENT_LOG_FRAME


def stream_topic(spark: SparkSession, **options: str) -> DataFrame:
    """Keyed text messages of the topic.  Offsets live in the query's checkpoint."""
    messages = spark.readStream.format("kafka").options(**event_log_read_options(**options)).load()
    return messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def stream_staged_messages(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Messages staged as Parquet files, picked up as they appear."""
    reader = spark.readStream.schema(EVENT_LOG_FRAME)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
