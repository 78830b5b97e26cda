"""Synthetic people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.processor import ERROR, create_people, person_id_from
from rollcall.schemas import PERSON_FIELDS

# Names, cities and domains of generated people.
NAMES = ("Alice", "Bob", "Carol", "David", "Eve", "Frank", "Grace", "Henry")
CITIES = ("San Francisco", "New York", "Seattle", "Austin", "Boston", "Chicago")
DOMAINS = ("example.com", "test.com", "demo.org")
DEFAULT_FILE_ROWS, DEFAULT_TOPIC_ROWS, DEFAULT_LANDING_ROWS = 1000, 100, 500


def _pick(values: tuple[str, ...], i: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), F.pmod(i, F.lit(len(values)).cast("bigint")))


def people_from_index(
    index: DataFrame, i: str = "i", created_at: Column | None = None
) -> DataFrame:
    """One person per index value.  Ids are hashed from it, so a retried task agrees."""
    number = F.col(i).cast("bigint")
    text = number.cast("string")
    raw = index.select(
        number.alias("i"),
        F.concat(_pick(NAMES, number), F.lit(" Smith-"), text).alias("name"),
        F.concat(F.lit("user"), text, F.lit("@"), _pick(DOMAINS, number)).alias("email"),
        (F.lit(18) + F.pmod(number, F.lit(50).cast("bigint"))).cast("int").alias("age"),
        _pick(CITIES, number).alias("city"),
    )
    person_id = person_id_from(F.concat(F.lit("person-"), F.col("i").cast("string")))
    created = create_people(raw, person_id, created_at)
    return created.filter(F.col(ERROR).isNull()).select(*PERSON_FIELDS)


def generate_people(
    spark: SparkSession, rows: int = DEFAULT_FILE_ROWS, created_at: Column | None = None
) -> DataFrame:
    return people_from_index(spark.range(1, rows + 1), "id", created_at)
