import json

import pytest
from pyspark.sql import functions as F

from rollcall.operators import events as E
from rollcall.schemas import EVENT_FIELDS

EVENT = {
    "id": "i1", "name": "Ann", "email": "a@b.co", "age": 20, "city": "Paris", "status": "Active",
    "createdAt": "2024-01-01T00:00:00Z", "eventTime": 1735311600000,
}


def messages(spark, *values):
    texts = [v if isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_round_trip(people):
    sent = E.to_events(people({}, {"name": 'quo"te\né'}), F.lit(1735311600000))
    encoded = E.encode_events(sent)
    assert encoded.columns == ["key", "value"]
    back = E.decode_events(encoded).filter("error is null").select(*EVENT_FIELDS)
    assert sorted(back.collect()) == sorted(sent.collect())


def test_events_get_the_wall_clock_by_default(people):
    row = E.to_events(people({})).select("eventTime", F.unix_millis(F.current_timestamp()).alias("now")).first()
    assert row.eventTime == row.now


def test_unknown_fields_are_ignored_and_missing_ones_are_errors(spark):
    rows = E.decode_events(messages(spark, EVENT | {"x": {"y": 1}})).collect()
    assert rows[0].error is None and rows[0].eventTime == 1735311600000
    for field in EVENT_FIELDS:
        row = E.decode_events(messages(spark, {k: v for k, v in EVENT.items() if k != field})).first()
        assert (row.error, row.error_rule) == (f"Missing {field}", field)


def test_bad_messages_go_to_the_quarantine(spark):
    decoded = E.decode_events(messages(spark, "{bad", EVENT, EVENT | {"name": None}))
    assert E.lake_rows(decoded).count() == 1
    reasons = {r.value: r.error for r in E.quarantine_rows(decoded).collect()}
    assert reasons["{bad"] == "Parse error: malformed JSON" and len(reasons) == 2


def test_strict_decoding_fails_the_query(spark):
    assert E.decode_events(messages(spark, EVENT), strict=True).count() == 1
    with pytest.raises(Exception, match="malformed JSON"):
        E.decode_events(messages(spark, EVENT, "{bad"), strict=True).collect()


def test_event_time_falls_back_to_the_wall_clock(spark):
    df = spark.createDataFrame([(1735311600000,), (None,)], "eventTime bigint")
    rows = df.select(E.event_timestamp(F.col("eventTime")).alias("t"), F.current_timestamp().alias("now")).collect()
    assert rows[0].t.isoformat() == "2024-12-27T15:00:00" and rows[1].t == rows[1].now


def test_partition_keys(spark):
    df = spark.createDataFrame([(1735311600000,), (1735311599999,), (0,)], "eventTime bigint")
    keys = [(r.dt, r.hour) for r in E.partition_keys(df).orderBy(F.desc("eventTime")).collect()]
    assert keys == [("2024-12-27", "15"), ("2024-12-27", "14"), ("1970-01-01", "00")]


@pytest.fixture
def views(spark):
    batch = [(1, "d1", "00", "batch"), (2, "d1", "02", "batch"), (2, "d1", "02", "batch")]
    speed = [(i, "d1", f"{i % 5:02d}", "speed") for i in range(40)]
    schema = "n int, dt string, hour string, layer string"
    return spark.createDataFrame(batch, schema), spark.createDataFrame(speed, schema)


def merged_rows(batch, speed):
    return sorted(map(tuple, E.lambda_merge(batch, speed).collect()))


def expected_rows(batch, speed):
    closed = {(r.dt, r.hour) for r in batch.collect()}
    fresh = [tuple(r) for r in speed.collect() if (r.dt, r.hour) not in closed]
    return sorted([tuple(r) for r in batch.collect()] + fresh)


def test_lambda_merge_plans_without_running_a_job(views):
    spark = views[0].sparkSession
    spark.sparkContext.setJobGroup("plan", "")
    try:
        E.lambda_merge(*views)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_without_an_hour_count_once(spark):
    kind = "n int, dt string, hour string"
    batch = spark.createDataFrame([(1, None, None), (2, "d", "01")], kind)
    speed = spark.createDataFrame([(1, None, None), (3, "d", None)], kind)
    assert sorted(r.n for r in E.lambda_merge(batch, speed).collect()) == [1, 2, 3]



def test_hourly_figures(spark):
    rows = [(0, 10), (3_599_999, 20), (3_600_000, 30)]
    df = spark.createDataFrame(rows, "eventTime bigint, age int")
    df = df.withColumn("event_ts", E.event_timestamp(F.col("eventTime")))
    first, second = E.hourly_figures(df).orderBy("window_start").collect()
    assert (first.events, first.avg_age) == (2, 15.0) and first.stddev_age == pytest.approx(7.0710678)
    assert (second.events, second.avg_age, second.stddev_age) == (1, 30.0, None)
