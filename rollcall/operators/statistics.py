"""Aggregations over people.

Every group is reduced map-side before its shuffle, so a city or domain that
holds a third of all rows reaches the exchange as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.people import AGE_GROUPS, OLDEST_GROUP, age_group, domain_or_unknown


def _count() -> Column:
    return F.count(F.lit(1))


def one_decimal(value: Column) -> Column:
    """Text with one decimal, halves rounded up; null for null."""
    return F.when(value.isNotNull(), F.format_string("%.1f", value))


def percentage(part: Column, total: Column) -> Column:
    share = part.cast("double") / F.nullif(total, F.lit(0)) * 100
    return F.when(share.isNotNull(), F.format_string("%.1f%%", share))


def average_age(age: Column) -> Column:
    """Average to one decimal."""
    return one_decimal(F.sum(age).cast("double") / F.count(age)).cast("double")


def city_statistics(df: DataFrame) -> DataFrame:
    """Per city: rows, age average, bounds, sample deviation, distinct states."""
    return (
        df.groupBy("city")
        .agg(
            _count().alias("total_people"),
            F.avg("age").alias("avg_age"),
            F.min("age").alias("min_age"),
            F.max("age").alias("max_age"),
            F.stddev("age").alias("stddev_age"),
            F.count_distinct("status").alias("distinct_statuses"),
        )
        .orderBy(F.desc("total_people"), "city")
    )


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(_count().alias("total_records"))


def city_report(people: DataFrame) -> DataFrame:
    return (
        people.groupBy("city")
        .agg(
            _count().alias("total_people"),
            average_age(F.col("age")).alias("avg_age"),
            F.min("age").alias("min_age"),
            F.max("age").alias("max_age"),
        )
        .orderBy(F.desc("total_people"), "city")
    )


def _band_counters(counted: Column | None = None) -> list[Column]:
    band = age_group(F.col("age"))
    held = F.lit(True) if counted is None else counted
    return [F.count_if((band == label) & held).alias(f"_band{i}") for i, label in enumerate(_BANDS)]


_BANDS = tuple(label for _, label in AGE_GROUPS) + (OLDEST_GROUP,)


def age_group_distribution(people: DataFrame) -> DataFrame:
    """Rows and share per age band; bands without rows are left out.

    One row of counters is enough: the total comes with it, so there is neither
    a shuffle by band nor a second pass for the percentages.
    """
    counted = people.agg(_count().alias("_total"), *_band_counters())
    bands = F.array(
        *[
            F.struct(F.lit(label).alias("age_group"), F.col(f"_band{i}").alias("count"))
            for i, label in enumerate(_BANDS)
        ]
    )
    return (
        counted.select("_total", F.inline(bands))
        .filter(F.col("count") > 0)
        .select("age_group", "count", percentage(F.col("count"), F.col("_total")).alias("percentage"))
        .orderBy(F.desc("count"), "age_group")
    )


def status_distribution(people: DataFrame) -> DataFrame:
    return people.groupBy("status").agg(_count().alias("count"))


def domain_distribution(people: DataFrame) -> DataFrame:
    domain = domain_or_unknown(F.col("email")).alias("domain")
    return people.groupBy(domain).agg(_count().alias("count"))


def batch_profile(people: DataFrame) -> DataFrame:
    return people.agg(
        _count().alias("records"),
        F.count_distinct("city").alias("unique_cities"),
        F.min("age").alias("_low"),
        F.max("age").alias("_high"),
    ).select(
        "records",
        "unique_cities",
        F.concat(F.col("_low").cast("string"), F.lit(" - "), F.col("_high").cast("string")).alias(
            "age_range"
        ),
    )


def combined_report(people: DataFrame) -> DataFrame:
    """City, age-group, status, domain and total figures from one scan and one shuffle.

    The result is a table with one row per figure, so it may hold any number of
    cities and domains.  Only the grand-total row feeds the age bands: it carries
    their counters, and is unfolded into the total and one row per band.  A row that counts
    for nothing is added, so that a report of nobody still says so: its total is 0.
    """
    keyed = people.select(
        "city",
        "status",
        domain_or_unknown(F.col("email")).alias("domain"),
        "age",
        F.lit(1).alias("_n"),
    )
    nobody = people.sparkSession.range(1).select(F.lit(0).alias("_n"))
    keyed = keyed.unionByName(nobody, allowMissingColumns=True)
    grouped = keyed.groupingSets(
        [["city"], ["status"], ["domain"], []], "city", "status", "domain"
    ).agg(
        F.grouping_id().alias("_set"),
        F.sum("_n").alias("_rows"),
        F.sum("age").alias("_sum"),
        F.count("age").alias("_ages"),
        F.min("age").alias("_low"),
        F.max("age").alias("_high"),
        *_band_counters(F.col("_n") == 1),
    )

    def entry(section: Column, key: Column, count: Column, share: Column, with_ages: bool) -> Column:
        def only(value: Column, kind: str) -> Column:
            return (value if with_ages else F.lit(None)).cast(kind)

        return F.struct(
            section.alias("section"),
            key.cast("string").alias("key"),
            count.alias("count"),
            only(one_decimal(F.col("_sum").cast("double") / F.col("_ages")), "double").alias("avg_age"),
            only(F.col("_low"), "int").alias("min_age"),
            only(F.col("_high"), "int").alias("max_age"),
            share.cast("string").alias("percentage"),
        )

    nothing = F.lit(None)
    rows = F.col("_rows")
    totals = F.array(
        entry(F.lit("total"), nothing, rows, nothing, False),
        *[
            entry(
                F.lit("age_group"),
                F.lit(label),
                F.col(f"_band{i}"),
                percentage(F.col(f"_band{i}"), rows),
                False,
            )
            for i, label in enumerate(_BANDS)
        ],
    )
    # grouping_id has one bit per key, set where the key is not grouped on.
    entries = (
        F.when(F.col("_set") == 0b011, F.array(entry(F.lit("city"), F.col("city"), rows, nothing, True)))
        .when(
            F.col("_set") == 0b101,
            F.array(entry(F.lit("status"), F.col("status"), rows, nothing, False)),
        )
        .when(
            F.col("_set") == 0b110,
            F.array(entry(F.lit("domain"), F.col("domain"), rows, nothing, False)),
        )
        .otherwise(totals)
    )
    return grouped.select(F.inline(entries)).filter((F.col("count") > 0) | (F.col("section") == "total"))
