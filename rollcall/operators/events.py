"""Person events: encoding, decoding, partition keys, hourly figures, lambda merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.config import WINDOW_LENGTH
from rollcall.functions.clock import partition_date, partition_hour
from rollcall.functions.codec import MALFORMED, decode_column, to_json_text
from rollcall.functions.rules import required
from rollcall.functions.text import whole_number
from rollcall.operators.processor import ERROR, RULE, RecordSpec, check
from rollcall.schemas import EVENT_FIELDS, EVENT_TEXT, PERSON_FIELDS

HOUR_PARTS = ("events", "ages", "age_sum", "age_squares")


def to_events(people: DataFrame, event_time: Column | None = None) -> DataFrame:
    """People as events; the time is the wall clock unless a column is given for replay."""
    millis = F.unix_millis(F.current_timestamp()) if event_time is None else event_time
    return people.select(*PERSON_FIELDS, millis.alias("eventTime"))


def encode_events(events: DataFrame) -> DataFrame:
    """Keyed messages: key is the person id, value the event as JSON."""
    return events.select(F.col("id").alias("key"), to_json_text(EVENT_FIELDS).alias("value"))


def decode_events(messages: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """Messages to event columns plus `error`.

    Every field of a lake row must be present.  By default bad messages keep
    their error for the quarantine; with `strict` the first one fails the query.
    """
    passed = [c for c in messages.columns if c not in EVENT_FIELDS]
    columns = decode_column(messages, value, EVENT_TEXT, passed).withColumns(
        {
            "age": whole_number(F.col("age")).try_cast("int"),
            "eventTime": whole_number(F.col("eventTime")),
        }
    )
    rules = {"json": F.when(F.col(MALFORMED), F.lit("Parse error: malformed JSON"))}
    rules |= {name: required(F.col(name), name) for name in EVENT_FIELDS}
    checked = check(columns, RecordSpec(EVENT_FIELDS, rules)).drop(MALFORMED)
    if strict:
        failure = F.raise_error(F.col(ERROR)).cast("boolean")
        checked = checked.filter(F.when(F.col(ERROR).isNull(), F.lit(True)).otherwise(failure))
    return checked


def event_timestamp(event_time: Column) -> Column:
    """Event time, or the wall clock for events without one."""
    return F.coalesce(F.timestamp_millis(event_time), F.current_timestamp())


def partition_keys(df: DataFrame, event_time: str = "eventTime") -> DataFrame:
    """Add dt and hour of the event time, in UTC."""
    millis = F.col(event_time)
    return df.withColumns({"dt": partition_date(millis), "hour": partition_hour(millis)})


def lake_rows(decoded: DataFrame) -> DataFrame:
    """Complete events in lake layout."""
    good = decoded.filter(F.col(ERROR).isNull())
    return partition_keys(good.select(*EVENT_FIELDS))


def quarantine_rows(decoded: DataFrame, value: str = "value") -> DataFrame:
    return decoded.filter(F.col(ERROR).isNotNull()).select(value, ERROR, RULE)


def hourly_figures(events: DataFrame, timestamp: str = "event_ts") -> DataFrame:
    """Tumbling-hour count, average and deviation of age; batch and stream alike."""
    hour = F.window(timestamp, WINDOW_LENGTH)
    return (
        events.groupBy(hour)
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.avg("age").alias("avg_age"),
            F.stddev("age").alias("stddev_age"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "events",
            "avg_age",
            "stddev_age",
        )
    )


def lambda_merge(batch: DataFrame, speed: DataFrame) -> DataFrame:
    """Batch rows for the hours the batch view holds, speed rows for every other hour.

    Both inputs carry dt and hour; rows without an hour are an hour like any other.  The hours
    are reduced in each task first.  The join carries no hint: adaptive execution sends the
    hours to every task where they are measured to be few, and else splits a large hour.
    """
    hours = batch.select(F.col("dt").alias("_dt"), F.col("hour").alias("_hour")).distinct()
    known = speed["dt"].eqNullSafe(hours["_dt"]) & speed["hour"].eqNullSafe(hours["_hour"])
    return batch.unionByName(speed.join(hours, known, "left_anti"), allowMissingColumns=True)


def late_after_close(closed: DataFrame, hours: DataFrame) -> DataFrame:
    """Closed hours with `late`: how many of their events came after the hour was closed.

    ``hours`` are the figures of all events so far, which hold the late ones too; figures that lag
    behind the closed hours count nothing rather than less than nothing.
    """
    seen = hours.select("window_start", "window_end", F.col("events").alias("_seen"))
    late = F.greatest(F.coalesce("_seen", F.lit(0)) - F.col("events"), F.lit(0)).alias("late")
    return closed.join(seen, ["window_start", "window_end"], "left").select(*closed.columns, late)


def hourly_parts(events: DataFrame, timestamp: str = "event_ts") -> DataFrame:
    """Whole-number parts of an hour's figures, which add up: events, ages, their sum and squares."""
    age = F.col("age").cast("bigint")
    return (
        events.groupBy(F.window(timestamp, WINDOW_LENGTH))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count(age).alias("ages"),
            F.sum(age).alias("age_sum"),
            F.sum(age * age).alias("age_squares"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *HOUR_PARTS)
    )


def figures_of_parts(parts: DataFrame) -> DataFrame:
    """Hourly figures from parts of any number of batches."""
    summed = parts.groupBy("window_start", "window_end").agg(*[F.sum(c).alias(c) for c in HOUR_PARTS])
    n, total = F.col("ages"), F.col("age_sum").cast("double")
    spread = (F.col("age_squares") - total * total / n) / (n - 1)
    return summed.select(
        "window_start",
        "window_end",
        "events",
        F.when(n > 0, total / n).alias("avg_age"),
        F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("stddev_age"),
    )
