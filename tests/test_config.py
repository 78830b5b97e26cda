import pytest

from rollcall import config


def test_locations_follow_the_environment():
    local = config.Locations.from_env({})
    assert local.people_lake == "data/streaming/people" and local.people_jsonl == "data/raw/people.jsonl"
    remote = config.Locations.from_env({"ENV": "prod", "S3_BUCKET": "s3a://bucket/"})
    assert remote.people_stats == "s3a://bucket/output/people_stats.parquet"
    assert remote.people_parquet == "s3a://bucket/processed/people.parquet"
    assert remote.analytics_report == "s3a://bucket/output/analytics.json"
    with pytest.raises(ValueError):
        config.Locations.from_env({"ENV": "prod"})


def test_event_log_options():
    reading = config.event_log_read_options(**{"kafka.bootstrap.servers": "b:1"})
    assert reading["startingOffsets"] == "earliest" and reading["subscribe"] == "people-events"
    assert reading["kafka.bootstrap.servers"] == "b:1"
    assert config.event_log_write_options()["kafka.acks"] == "all"
    assert config.bootstrap_servers({"KAFKA_BOOTSTRAP_SERVERS": "x:9"}) == "x:9"
    assert config.bootstrap_servers({}) == "localhost:9092"


def test_scratch_folders_come_from_the_session(spark):
    first, second = config.scratch_dir(spark, "a"), config.scratch_dir(spark, "a")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert first != second and (shared is None or first.startswith(shared))
