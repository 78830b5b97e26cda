import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQueryException

from rollcall.operators import events as E
from rollcall.plans import jobs
from rollcall.sinks.event_log import publish_acknowledged, publish_staged
from rollcall.sinks.files import append_to_lake, write_lake
from rollcall.sources.event_log import stream_staged_messages, stream_topic
from rollcall.sources.files import compact_lake, read_lake, scan_data_files
from rollcall.streaming import ingest

HOUR = 3_600_000
DAY = 1_704_067_200_000  # 2024-01-01


def event(n, millis, **changes):
    row = {
        "id": f"00000000-0000-4000-8000-{n:012d}", "name": f"P{n}", "email": f"u{n}@test.com", "age": 20 + n % 50,
        "city": "Paris", "status": "Active", "createdAt": "2024-01-01T00:00:00Z", "eventTime": millis,
    }
    return json.dumps(row | changes)


class Platform:
    """A staged topic, a lake and checkpoints below one folder."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.topic, self.lake, self.bad = (str(root / n) for n in ("topic", "lake", "bad"))

    def publish(self, *values):
        rows = [(str(i), v) for i, v in enumerate(values)]
        df = self.spark.createDataFrame(rows, "key string, value string").coalesce(1)
        return publish_staged(df, self.topic)

    def stream(self, **options):
        return stream_staged_messages(self.spark, self.topic, **options)

    def checkpoint(self, name):
        return str(self.root / f"cp-{name}")

    def ingest(self, **options):
        kept = {} if options.get("strict") else {"quarantine": self.bad}
        query = ingest.ingest_to_lake(self.stream(), self.lake, self.checkpoint("lake"), interval=None, **kept, **options)
        query.awaitTermination()

    def rows(self):
        return read_lake(self.spark, self.lake)


@pytest.fixture
def platform(spark, tmp_path):
    return Platform(spark, tmp_path)


def test_stream_equals_batch_and_restart_adds_nothing(platform):
    platform.publish(*[event(n, DAY + n * HOUR // 2) for n in range(20)], "{bad", event(21, DAY, name=None))
    platform.ingest()
    batch = E.lake_rows(E.decode_events(platform.spark.read.parquet(platform.topic)))
    assert sorted(platform.rows().collect()) == sorted(batch.collect()) and batch.count() == 20
    platform.ingest()
    assert platform.rows().count() == 20
    platform.publish(event(30, DAY + 40 * HOUR))
    platform.ingest()
    assert platform.rows().count() == 21


def test_late_events_land_in_their_own_hour(platform):
    platform.publish(event(1, DAY + 50 * HOUR))
    platform.ingest()
    platform.publish(event(2, DAY))
    platform.ingest()
    rows = {(r.dt, r.hour) for r in platform.rows().collect()}
    assert rows == {("2024-01-03", "02"), ("2024-01-01", "00")}


def test_a_hot_hour_is_split_and_the_others_share(platform, spark):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    hot = event(1, DAY)  # a third of the messages are copies of one
    values = [hot if n % 3 == 0 else event(n, DAY + (1 + n % 12) * HOUR) for n in range(3000)]
    platform.publish(*values)
    spark.conf.set(size, "4k")
    try:
        platform.ingest()
    finally:
        spark.conf.unset(size)
    assert platform.rows().count() == 3000
    files = [f.parent.parent.name for f in (platform.root / "lake").rglob("*.parquet")]
    assert files.count("hour=00") >= 1 and len(files) < 200


def test_two_queries_and_a_new_checkpoint_keep_all_rows(platform):
    platform.publish(*[event(n, DAY + n * HOUR) for n in range(5)], "{bad")
    for name in ("one", "two"):
        ingest.ingest_to_lake(
            platform.stream(), platform.lake, platform.checkpoint(name), platform.bad, interval=None
        ).awaitTermination()
    assert platform.rows().count() == 10
    assert ingest.read_quarantine(platform.spark, platform.bad).count() == 2


def test_bad_messages_must_go_somewhere(platform):
    platform.publish(event(1, DAY))
    with pytest.raises(ValueError):
        ingest.ingest_to_lake(platform.stream(), platform.lake, platform.checkpoint("x"), interval=None)


def test_landed_batches_share_the_streams_root(platform):
    platform.publish(*[event(n, DAY) for n in range(5)])
    platform.ingest()
    jobs.generate(platform.spark, platform.lake, 5, F.lit(DAY))
    assert platform.rows().count() == 10 == scan_data_files(platform.spark, platform.lake).count()


def test_a_quarantine_without_rows_is_an_empty_table(platform):
    platform.publish(event(1, DAY))
    platform.ingest()
    assert ingest.read_quarantine(platform.spark, platform.bad).count() == 0


def test_strict_ingest_fails_on_the_first_bad_message(platform):
    platform.publish(event(1, DAY), "{bad")
    with pytest.raises(StreamingQueryException):
        platform.ingest(strict=True)


def test_quarantine_keeps_message_and_reason(platform):
    platform.publish(event(1, DAY), "{bad", event(2, DAY, city=None))
    ingest.quarantine_stream(
        platform.stream(), platform.bad, platform.checkpoint("bad"), interval=None
    ).awaitTermination()
    rows = {r.error: r.value for r in platform.spark.read.parquet(platform.bad).collect()}
    assert rows["Parse error: malformed JSON"] == "{bad" and set(rows) == {"Parse error: malformed JSON", "Missing city"}


def run_validated(platform):
    ingest.ingest_validated(
        platform.stream(), platform.lake, platform.bad, platform.checkpoint("ok"), interval=None
    ).awaitTermination()


def test_validated_ingest_writes_both_sides_once(platform):
    platform.publish(event(1, DAY, status="SuspendedX:a"), event(2, DAY, age=150), "{bad", event(3, DAY + HOUR))
    run_validated(platform)
    run_validated(platform)
    rows = platform.rows().orderBy("id").collect()
    assert [(r.status, r.hour) for r in rows] == [("Suspended:a", "00"), ("Active", "01")]
    bad = platform.spark.read.parquet(platform.bad)
    assert {r.error_rule for r in bad.collect()} == {"age", "json"}


def test_a_repeated_batch_replaces_itself_alone(platform):
    """Writing a batch again, as after a lost driver, changes nothing."""
    rows = E.decode_events(
        platform.spark.createDataFrame([(event(1, DAY),), (event(2, DAY + HOUR),)], "value string")
    ).drop("value", "error", "error_rule")
    for name in ("q-0", "q-1", "q-0", "p-0"):
        append_to_lake(rows, platform.lake, name)
    assert platform.rows().count() == 6


def test_hourly_figures_are_complete_and_late_events_change_them(platform):
    out = str(platform.root / "hours")

    def run():
        ingest.hourly_stream(platform.stream(), out, platform.checkpoint("h"), interval=None).awaitTermination()
        rows = ingest.read_hours(platform.spark, out).orderBy("window_start").collect()
        return [(r.window_start.hour, r.events, r.avg_age) for r in rows]

    platform.publish(*[event(n, DAY + n * HOUR // 4, age=30) for n in range(13)])  # 00:00 .. 03:00
    assert run() == [(0, 4, 30.0), (1, 4, 30.0), (2, 4, 30.0), (3, 1, 30.0)]
    assert run()[3] == (3, 1, 30.0)
    platform.publish(event(50, DAY + 5, age=80))
    assert run()[0] == (0, 5, 40.0)


def test_closed_hours_follow_the_watermark(platform):
    platform.publish(*[event(n, DAY + n * HOUR // 4) for n in range(13)])
    out = str(platform.root / "closed")
    ingest.closed_hours_stream(platform.stream(), out, platform.checkpoint("c"), interval=None).awaitTermination()
    rows = platform.spark.read.parquet(out).orderBy("window_start").collect()
    # The hour that ends at the last event is within the lateness bound and stays open.
    assert [(r.window_start.hour, r.events) for r in rows] == [(0, 4), (1, 4)]


@pytest.mark.parametrize("validated", [False, True])
def test_a_streamed_lake_and_landed_batches_are_analysed_together(platform, validated):
    spark, landed = platform.spark, str(platform.root / "landed batches")
    platform.publish(*[event(n, DAY + n * HOUR) for n in range(4)])
    run_validated(platform) if validated else platform.ingest()
    jobs.generate(spark, landed, 50, F.lit(DAY))
    lake = [platform.lake, landed, str(platform.root / "absent")]
    inventory, validation = jobs.validate(spark, lake)
    assert validation.first().records_read == 54
    history = jobs.export_history(spark, lake).collect()
    assert len(history) == inventory.first().files and all(r.records for r in history)
    assert max(r.cumulative_total for r in history) == 54
    records, _ = jobs.batch_analytics(spark, lake[:2], str(platform.root / "stats"))
    assert records == 54
    days = {(r.dt, r.hour) for r in scan_data_files(spark, lake).collect()}
    assert days == {("2024-01-01", f"{h:02d}") for h in range(4)}


def test_publish_counts(platform):
    df = platform.spark.createDataFrame([("k", "v"), (None, "v"), ("k", None)], "key string, value string")
    counts = publish_staged(df, platform.topic)
    assert (counts.success, counts.failure) == (1, 2)
    assert platform.spark.read.parquet(platform.topic).count() == 1


def test_files_per_trigger_splits_the_backlog(platform):
    for n in range(3):
        platform.publish(event(n, DAY))
    query = ingest.ingest_to_lake(
        platform.stream(files_per_trigger=1), platform.lake, platform.checkpoint("lake"), platform.bad, interval=None
    )
    query.awaitTermination()
    assert query.lastProgress.batchId == 2 and platform.rows().count() == 3


def test_kafka_source_asks_for_the_connector(spark):
    """The connector is not on this machine; the options reach the source all the same."""
    try:
        assert stream_topic(spark).isStreaming
    except Exception as error:
        assert "kafka" in str(error).lower()


def test_late_events_of_closed_hours_are_counted_over_restarts(platform):
    spark, closed, hours = platform.spark, str(platform.root / "closed"), str(platform.root / "hours")

    def run(*events):
        platform.publish(*events)
        for start, out in ((ingest.closed_hours_stream, closed), (ingest.hourly_stream, hours)):
            start(platform.stream(), out, platform.checkpoint(out[-6:].strip("/")), interval=None).awaitTermination()
        rows = E.late_after_close(ingest.read_closed_hours(spark, closed), ingest.read_hours(spark, hours))
        return [(r.window_start.hour, r.events, r.late) for r in rows.orderBy("window_start").collect()]

    assert run(event(0, DAY), event(1, DAY + HOUR + 1), event(2, DAY + 2 * HOUR)) == [(0, 1, 0)]
    # Hour 1 is open still and takes its event; hour 0 is closed.
    late = [event(3, DAY + 5), event(4, DAY + HOUR + 5), event(5, DAY + 6)]
    assert run(*late, event(6, DAY + 3 * HOUR)) == [(0, 1, 2), (1, 2, 0)]
    assert run(event(7, DAY + 4 * HOUR)) == [(0, 1, 2), (1, 2, 0), (2, 1, 0)]


def test_figures_that_lag_behind_lose_nothing(platform):
    stamps = "window_start timestamp, window_end timestamp, events long"
    one = [(datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 1), 3)]
    closed, older = platform.spark.createDataFrame(one, stamps), platform.spark.createDataFrame([(*one[0][:2], 1)], stamps)
    assert [r.late for r in E.late_after_close(closed, older).collect()] == [0]
    assert [r.late for r in E.late_after_close(closed, older.limit(0)).collect()] == [0]


def test_a_hanging_batch_is_stopped_and_run_again(platform):
    platform.publish(event(0, DAY))
    out, slow = str(platform.root / "out"), [True]

    def write(batch, batch_id):
        def sleep(rows):
            time.sleep(60)
            yield from rows

        if slow[0]:
            batch = batch.mapInArrow(sleep, batch.schema)
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def start():
        writer = platform.stream().writeStream.foreachBatch(write).trigger(availableNow=True)
        return writer.option("checkpointLocation", platform.checkpoint("slow")).start()

    began = time.monotonic()
    with pytest.raises(ingest.BatchTimeout):
        ingest.run_within(start(), batch_seconds=2, poll_seconds=0.2)
    assert time.monotonic() - began < 40
    slow[0] = False
    ingest.run_within(start(), batch_seconds=60, poll_seconds=0.2)
    assert platform.spark.read.parquet(out).count() == 1


def test_outcomes_of_a_log_that_refuses_some(platform):
    rows = [(str(n) if n % 5 else None, "x" * n if n % 7 else None) for n in range(200)]
    df = platform.spark.createDataFrame(rows, "key string, value string").repartition(4)
    path = str(platform.root / "outcomes")

    def open_sender():
        return lambda batch: ["Too large" if len(value) > 150 else None for _, value in batch]

    counts = publish_acknowledged(df, open_sender, path)
    expected = ["No key or no value" if k is None or v is None else "Too large" if len(v) > 150 else None for k, v in rows]
    assert (counts.success, counts.failure) == (expected.count(None), len(rows) - expected.count(None))
    found = sorted((r.key or "", r.value or "", r.error or "") for r in platform.spark.read.parquet(path).collect())
    assert found == sorted((k or "", v or "", e or "") for (k, v), e in zip(rows, expected, strict=True))


def test_outcomes_of_a_task_that_runs_again_count_once(platform):
    df = platform.spark.createDataFrame([("k", "v")] * 20, "key string, value string").repartition(1)
    path, tried = str(platform.root / "again"), str(platform.root / "tried")

    def open_sender():
        again = os.path.exists(tried)
        open(tried, "w").close()

        def deliver(batch):
            if not again:
                os._exit(1)  # the worker is lost with its first batch
            return [None] * len(batch)

        return deliver

    with pytest.raises(Exception, match="(?i)crash|exit|abort|fail"):
        publish_acknowledged(df, open_sender, path)  # a local session does not retry tasks
    counts = publish_acknowledged(df, open_sender, path)
    assert counts.success == 20 and platform.spark.read.parquet(path).count() == 20


def test_a_sender_must_answer_for_each_message(platform):
    df = platform.spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(Exception, match="1 messages sent, 0 answers"):
        publish_acknowledged(df, lambda: lambda batch: [], str(platform.root / "short"))


def test_history_reads_new_files_only(platform):
    spark, lake, store = platform.spark, str(platform.root / "a lake"), str(platform.root / "store")
    people = [json.loads(event(n, DAY + n * HOUR)) for n in range(6)]
    kinds = "id string, name string, email string, age int, city string, status string, createdAt string, eventTime long"
    for part in (people[:4], people[4:] + [people[0] | {"age": 150}]):
        write_lake(spark.createDataFrame(part, kinds), lake)
        assert jobs.refresh_history(spark, lake, store, most_files=2) == len(part)
        assert jobs.refresh_history(spark, lake, store) == 0
        kept, whole = jobs.read_history(spark, lake, store), jobs.export_history(spark, lake)
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, whole.collect()))
    compact_lake(spark, lake)
    jobs.refresh_history(spark, lake, store)
    kept, whole = jobs.read_history(spark, lake, store), jobs.export_history(spark, lake)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, whole.collect()))


def test_history_of_no_files(platform):
    absent, store = str(platform.root / "absent"), str(platform.root / "store")
    assert jobs.refresh_history(platform.spark, absent, store) == 0
    assert jobs.read_history(platform.spark, absent, store).collect() == []
