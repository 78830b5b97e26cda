"""Views over the given tables.  The same text runs on Spark and on DuckDB.

Each rule has rows that break it, spread over the whole table by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.config import apply_session_settings
from rollcall.functions.codec import to_json_text
from rollcall.schemas import EVENT_FIELDS, PERSON_FIELDS

PEOPLE = """
SELECT c_custkey,
  CASE WHEN c_custkey % 59 = 0 THEN 'not-a-uuid'
       WHEN c_custkey % 79 = 0 THEN concat('ABC-1-2-3-', CAST(c_custkey AS VARCHAR(20)))
       ELSE concat('00000000-0000-4000-8000-', lpad(CAST(c_custkey AS VARCHAR(20)), 12, '0'))
  END AS id,
  CASE WHEN c_custkey % 53 = 0 THEN '   ' ELSE concat(chr(9), ' ', c_name, ' ') END AS name,
  CASE WHEN c_custkey % 71 = 0 THEN NULL
       WHEN c_custkey % 67 = 0 THEN '@@'
       WHEN c_custkey % 41 = 0 THEN concat('user', CAST(c_custkey AS VARCHAR(20)))
       ELSE concat('user', CAST(c_custkey AS VARCHAR(20)), '@',
         CASE c_custkey % 3 WHEN 0 THEN 'example.com' WHEN 1 THEN 'test.com' ELSE 'demo.org' END)
  END AS email,
  CASE WHEN c_custkey % 73 = 0 THEN NULL
       WHEN c_custkey % 47 = 0 THEN 150
       WHEN c_custkey % 43 = 0 THEN -1
       ELSE CAST(c_custkey % 90 AS INT) END AS age,
  CASE WHEN c_custkey % 37 = 0 THEN '  '
       WHEN c_custkey % 2 = 0 THEN concat(' ', lower(n_name))
       ELSE n_name END AS city,
  CASE c_custkey % 11 WHEN 0 THEN 'Inactive' WHEN 1 THEN 'Pending' WHEN 2 THEN 'Suspended:policy'
       WHEN 3 THEN 'Suspended' WHEN 4 THEN 'Suspended:a:b' WHEN 5 THEN 'Gone'
       WHEN 6 THEN 'Suspended:a:' ELSE 'Active' END AS status,
  CASE WHEN c_custkey % 61 = 0 THEN 'yesterday'
       WHEN c_custkey % 83 = 0
       THEN concat('2024-01-', lpad(CAST(1 + c_custkey % 28 AS VARCHAR(20)), 2, '0'), 'T10:00:00.500+02:00')
       ELSE concat('2024-01-', lpad(CAST(1 + c_custkey % 28 AS VARCHAR(20)), 2, '0'), 'T00:00:00Z')
  END AS createdAt
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

# An event carries its person, so the view needs no join.  `broken` marks messages
# whose JSON is cut off.
EVENTS = """
SELECT event_id, ts, event_id % 97 = 0 AS broken,
  concat('00000000-0000-4000-8000-', lpad(CAST(user_id AS VARCHAR(20)), 12, '0')) AS id,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE concat('User ', CAST(user_id AS VARCHAR(20))) END AS name,
  concat('user', CAST(user_id AS VARCHAR(20)), '@',
    CASE user_id % 3 WHEN 0 THEN 'example.com' WHEN 1 THEN 'test.com' ELSE 'demo.org' END) AS email,
  CASE WHEN event_id % 83 = 0 THEN 150 ELSE CAST((user_id + event_id) % 90 AS INT) END AS age,
  concat('City ', CAST(user_id % 12 AS VARCHAR(20))) AS city,
  CASE event_type WHEN 'purchase' THEN 'Active' WHEN 'view' THEN 'Inactive' WHEN 'click' THEN 'Pending'
       WHEN 'signup' THEN 'Suspended:policy' ELSE 'Gone' END AS status,
  '2024-01-01T00:00:00Z' AS createdAt,
  {millis} AS eventTime
FROM {events}
"""

RUN_LOG = """
SELECT CAST(user_id AS VARCHAR(20)) AS task_id,
  CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED'
       WHEN 'view' THEN 'RUNNING' ELSE 'PENDING' END AS status,
  event_id % 100 AS duration, event_id AS records_processed, event_id % 3 AS records_failed
FROM {events}
"""

SPARK_MILLIS = "unix_millis(CAST(ts AS TIMESTAMP))"
DUCKDB_MILLIS = "epoch_us(ts) // 1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return apply_session_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage rows.  The 25-row nation table is broadcast by its file size."""
    customer, nation = (table(spark, sf_dir, name) for name in ("customer", "nation"))
    return spark.sql(PEOPLE, customer=customer, nation=nation)


def person_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People as JSON text, with some lines cut off and some blank."""
    key = F.col("c_custkey")
    line = (
        F.when(key % 97 == 0, "{bad").when(key % 101 == 0, " \t").otherwise(to_json_text(PERSON_FIELDS))
    )
    return people(spark, sf_dir).select(line.alias("value"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = EVENTS.replace("{millis}", SPARK_MILLIS)
    return spark.sql(text, events=table(spark, sf_dir, "events"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("broken"), "{bad").otherwise(to_json_text(EVENT_FIELDS))
    return events(spark, sf_dir).select(F.col("id").alias("key"), value.alias("value"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RUN_LOG, events=table(spark, sf_dir, "events"))
