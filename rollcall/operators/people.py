"""Row-wise operators on people: enrichment, labels, anonymising, normalising."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import people as P
from rollcall.functions import rules
from rollcall.schemas import PERSON_FIELDS

SAMPLE_COLUMNS = ("name", "age", "city", "age_group", "email_domain")
SAMPLE_ROWS = 10
BATCH_SAMPLE_COLUMNS = ("name", "email", "age", "city", "status")
BATCH_SAMPLE_ROWS = 5


def enrich(df: DataFrame) -> DataFrame:
    """Add age_group, email_domain, name_length and is_active in one projection."""
    return df.withColumns(
        {
            "age_group": P.age_group(F.col("age")),
            "email_domain": P.email_domain(F.col("email")),
            "name_length": P.name_length(F.col("name")),
            "is_active": P.is_active(F.col("status")),
        }
    )


def attributes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_available": P.is_available(F.col("status")),
            "email_username": P.email_username(F.col("email")),
            "email_domain": P.email_domain(F.col("email")),
            "is_adult": P.is_adult(F.col("age")),
            "is_minor": P.is_minor(F.col("age")),
            "age_category": P.age_category(F.col("age")),
        }
    )


def categorize(df: DataFrame) -> DataFrame:
    return df.withColumn("category", P.categorize(F.col("age"), F.col("status")))


def anonymize(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"name": P.anonymous_name(F.col("id")), "email": F.lit(P.ANONYMOUS_EMAIL)}
    )


def summarize(df: DataFrame) -> DataFrame:
    text = P.summary(
        F.col("name"), F.col("age"), F.col("city"), rules.storage_status(F.col("status"))
    )
    return df.withColumn("summary", text)


def with_status(df: DataFrame, status: str) -> DataFrame:
    return df.withColumn("status", F.lit(status))


def normalize(df: DataFrame) -> DataFrame:
    return df.withColumns(rules.normal_values())


def to_storage(df: DataFrame) -> DataFrame:
    """The seven storage columns, values in canonical text form."""
    values = rules.canonical_values()
    return df.select(*[values.get(name, F.col(name)).alias(name) for name in PERSON_FIELDS])


def sample(df: DataFrame, columns: tuple[str, ...], rows: int, *order_by: str) -> DataFrame:
    """First rows in a given order, planned as a top-k rather than a full sort."""
    return df.orderBy(*order_by).limit(rows).select(*columns)


def enriched_sample(df: DataFrame) -> DataFrame:
    return sample(enrich(df), SAMPLE_COLUMNS, SAMPLE_ROWS, "id", "name")


def some_enriched(df: DataFrame) -> DataFrame:
    """Any few enriched rows; no more of the input is read than gives them."""
    return enrich(df).limit(SAMPLE_ROWS).select(*SAMPLE_COLUMNS)


def batch_sample(df: DataFrame) -> DataFrame:
    return sample(df, BATCH_SAMPLE_COLUMNS, BATCH_SAMPLE_ROWS, "id", "name")
