"""City statistics that merge: parts per batch, hour, city and status, and views made of them.

A part is a row of whole numbers for one status of one city in one hour of one lake batch.
Parts of different batches add up, and distinct statuses are counted as rows, so any number of
parts gives the same figures as the rows themselves.  The batch view holds the parts of the
lake as it was when the view was made, the speed view those of each stream batch.  A batch of
an hour is in both once the batch layer has caught up; the batch view's parts are then taken.
A late event is a new batch of an old hour, and so is neither lost nor counted twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.schemas import CITY_PARTS, LAKE_BATCH, PARTITION_KEYS

SOURCE = (*PARTITION_KEYS, LAKE_BATCH)
GROUP = (*SOURCE, "city", "status")
# How each part of a group is combined with others of it.
COMBINED = {
    "people": F.sum,
    "ages": F.sum,
    "age_sum": F.sum,
    "age_squares": F.sum,
    "min_age": F.min,
    "max_age": F.max,
}


def city_parts(events: DataFrame) -> DataFrame:
    """Parts of rows that carry dt, hour and batch.

    Rows are added up in each task first, so a city or hour that holds a third of all rows
    reaches the exchange as one row per task.
    """
    age = F.col("age").cast("bigint")
    parts = events.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("people"),
        F.count(age).alias("ages"),
        F.sum(age).alias("age_sum"),
        F.sum((age * age).cast("decimal(20,0)")).cast(CITY_PARTS["age_squares"].dataType).alias("age_squares"),
        F.min("age").alias("min_age"),
        F.max("age").alias("max_age"),
    )
    return parts.select(*CITY_PARTS.names)


def merged_parts(batch_view: DataFrame, speed_view: DataFrame) -> DataFrame:
    """Parts of both views; where both hold a batch of an hour, the batch view's.

    Batches are compared, not rows, and reduced in each task first.  No side is broadcast by
    hint: adaptive execution decides by measured size.
    """
    held = batch_view.select(*[F.col(c).alias(f"_{c}") for c in SOURCE]).distinct()
    known = F.lit(True)
    for c in SOURCE:
        known = known & speed_view[c].eqNullSafe(held[f"_{c}"])
    return batch_view.unionByName(speed_view.join(held, known, "left_anti"))


def _summed() -> list[Column]:
    return [how(name).cast(CITY_PARTS[name].dataType).alias(name) for name, how in COMBINED.items()]


def statistics_of_parts(parts: DataFrame, *keys: str) -> DataFrame:
    """Per city, or per given keys: rows, age average, bounds, sample deviation, distinct states.

    The same figures as `city_statistics` over the rows.  Sums are whole numbers until the last
    step, so their order does not matter.
    """
    keys = keys or ("city",)
    by_status = parts.groupBy(*keys, "status").agg(*_summed())
    summed = by_status.groupBy(*keys).agg(*_summed(), F.count("status").alias("distinct_statuses"))
    n = F.col("ages").cast("double")
    total, squares = F.col("age_sum"), F.col("age_squares")
    # n * squares - total * total is exact in decimals, so nothing cancels in floating point.
    exact = F.call_function(
        "try_subtract",
        F.try_multiply(F.col("ages").cast("decimal(19,0)"), squares),
        F.try_multiply(total.cast("decimal(19,0)"), total.cast("decimal(19,0)")),
    )
    rough = n * squares.cast("double") - F.pow(total.cast("double"), 2)
    spread = F.coalesce(exact.cast("double"), F.greatest(rough, F.lit(0.0)))
    return summed.select(
        *keys,
        F.col("people").alias("total_people"),
        F.when(n > 0, F.col("age_sum") / n).alias("avg_age"),
        "min_age",
        "max_age",
        F.when(n > 1, F.sqrt(spread / (n * (n - 1)))).alias("stddev_age"),
        "distinct_statuses",
    )
