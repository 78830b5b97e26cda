"""Locations, session settings, event-log options and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Folder and object names of the data platform.
ZONES = {"raw": "raw", "streaming": "streaming", "processed": "processed", "output": "output"}
PEOPLE_TOPIC = "people-events"
CONSUMER_GROUP = "people-lake"

# Stream timing.
TRIGGER_INTERVAL = "60 seconds"
# Longest time that one micro-batch may take.
COMMIT_TIMEOUT_SECONDS = 600.0
WATERMARK_DELAY = "10 seconds"
WINDOW_LENGTH = "1 hour"

# Settings the jobs are written for.  UTC matters for results; the rest for speed.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Lets a small lake write use all cores; large ones go by the advisory size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # The JVM compiles no method above 8000 bytecodes.  Beyond that Spark does better
    # with split projections than with one whole-stage method that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


@dataclass(frozen=True)
class Locations:
    """Where each data set lives, below one base folder or bucket."""

    base: str

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Locations:
        env = os.environ if env is None else env
        if env.get("ENV", "local") == "local":
            return cls("data")
        bucket = env.get("S3_BUCKET")
        if not bucket:
            raise ValueError("S3_BUCKET must be set when ENV is not 'local'")
        return cls(bucket.rstrip("/"))

    def zone(self, name: str) -> str:
        return f"{self.base}/{ZONES[name]}"

    @property
    def people_jsonl(self) -> str:
        return f"{self.zone('raw')}/people.jsonl"

    @property
    def people_lake(self) -> str:
        return f"{self.zone('streaming')}/people"

    @property
    def people_landed(self) -> str:
        """Batches landed beside the stream; lake readers take both roots."""
        return f"{self.zone('streaming')}/people_landed"

    @property
    def people_parquet(self) -> str:
        return f"{self.zone('processed')}/people.parquet"

    @property
    def people_stats(self) -> str:
        return f"{self.zone('output')}/people_stats.parquet"

    @property
    def analytics_report(self) -> str:
        return f"{self.zone('output')}/analytics.json"


def bootstrap_servers(env: Mapping[str, str] | None = None) -> str:
    env = os.environ if env is None else env
    return env.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")


def event_log_read_options(**overrides: str) -> dict[str, str]:
    """Options of the event-log source: whole topic from the earliest offset."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers(),
        "subscribe": PEOPLE_TOPIC,
        "kafka.group.id": CONSUMER_GROUP,
        "startingOffsets": "earliest",
        "kafka.session.timeout.ms": "30000",
    } | overrides


def event_log_write_options(**overrides: str) -> dict[str, str]:
    """Options of the event-log sink: wait for every replica, small batches, snappy."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers(),
        "topic": PEOPLE_TOPIC,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.batch.size": "16384",
        "kafka.linger.ms": "10",
        "kafka.buffer.memory": "33554432",
        "kafka.compression.type": "snappy",
    } | overrides


def apply_session_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings on a session the caller owns."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach, for staged tables and checkpoints.

    The cluster names the shared folder in ``spark.checkpoint.dir``.  A temporary
    folder of this machine is used only where that is unset and Spark is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="rollcall-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
