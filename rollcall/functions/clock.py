"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLIS_PER_HOUR = 3_600_000
SECONDS_PER_DAY = 86_400

INSTANT_PATTERN = (
    r"\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(?:\.\d{0,9})?(?:[Zz]|[+-]\d{2}:\d{2})"
)
_PLAIN_INSTANT = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z"


def _floor_div(c: Column, by: int) -> Column:
    """Integer floor division, right for instants before 1970 too."""
    return ((c - F.pmod(c, F.lit(by).cast("bigint"))) / by).cast("bigint")


def _two_digits(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def partition_date(millis: Column) -> Column:
    """`yyyy-MM-dd` of an epoch-millisecond instant, in UTC."""
    days = _floor_div(millis, SECONDS_PER_DAY * 1000).cast("int")
    return F.date_from_unix_date(days).cast("string")


def partition_hour(millis: Column) -> Column:
    """`HH` of an epoch-millisecond instant, in UTC, zero padded."""
    return _two_digits(F.pmod(_floor_div(millis, MILLIS_PER_HOUR), F.lit(24).cast("bigint")))


def hour_start_millis(millis: Column) -> Column:
    return millis - F.pmod(millis, F.lit(MILLIS_PER_HOUR).cast("bigint"))


def parse_instant(c: Column) -> Column:
    """ISO-8601 instant with `Z` or an offset; null when malformed or out of range."""
    text = F.upper(c)
    return F.when(c.rlike(rf"\A{INSTANT_PATTERN}\z"), F.try_to_timestamp(text))


def instant_text(c: Column) -> Column:
    """Canonical text of a valid instant: UTC, `Z`, and 0, 3, 6 or 9 fraction digits.

    The fraction is carried over as text, so nanoseconds survive although Spark
    timestamps hold microseconds.
    """
    seconds = F.unix_seconds(F.try_to_timestamp(F.regexp_replace(F.upper(c), r"\.\d*", "")))
    of_day = F.pmod(seconds, F.lit(SECONDS_PER_DAY).cast("bigint"))
    digits = F.rpad(F.regexp_extract(c, r"\.(\d*)", 1), 9, "0")
    fraction = (
        F.when(digits == "0" * 9, "")
        .when(digits.endswith("0" * 6), F.concat(F.lit("."), F.substring(digits, 1, 3)))
        .when(digits.endswith("0" * 3), F.concat(F.lit("."), F.substring(digits, 1, 6)))
        .otherwise(F.concat(F.lit("."), digits))
    )
    rebuilt = F.concat(
        partition_date(seconds * 1000),
        F.lit("T"),
        _two_digits(_floor_div(of_day, 3600)),
        F.lit(":"),
        _two_digits(F.pmod(_floor_div(of_day, 60), F.lit(60).cast("bigint"))),
        F.lit(":"),
        _two_digits(F.pmod(of_day, F.lit(60).cast("bigint"))),
        fraction,
        F.lit("Z"),
    )
    return F.when(c.rlike(rf"\A{_PLAIN_INSTANT}\z"), c).otherwise(rebuilt)


def millis_of(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp, rounding down."""
    return F.unix_millis(ts.cast("timestamp"))
