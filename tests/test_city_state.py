"""Parts of city statistics add up to the statistics of the rows, however they are split."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators import city_state
from rollcall.operators.statistics import city_statistics
from rollcall.plans import jobs
from rollcall.schemas import CITY_PARTS
from rollcall.sinks.files import append_to_lake
from rollcall.sources.files import read_lake

SCHEMA = "dt string, hour string, batch string, city string, status string, age int"


def events(spark, n=300, seed=1):
    draw = random.Random(seed)
    rows = [
        (f"2024-01-0{draw.randint(1, 3)}", f"0{draw.randint(0, 4)}", f"q-{draw.randint(0, 5)}", draw.choice(["a", "b", None]),
         draw.choice(["Active", "Suspended:x", "Suspended:y", None]), draw.choice([None, 0, 5, 149]))
        for _ in range(n)
    ]
    return spark.createDataFrame([*rows, ("2024-01-01", "00", "q-0", "one", "Active", 7), ("2024-01-01", "00", "q-0", "none", None, None)], SCHEMA)


def figures(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("pieces", [1, 3])
def test_parts_give_the_statistics_of_the_rows(spark, pieces):
    rows = events(spark)
    piece = F.pmod(F.hash("age", "status"), F.lit(pieces))
    parts = [city_state.city_parts(rows.filter(piece == n)) for n in range(pieces)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionAll(part)
    assert figures(city_state.statistics_of_parts(merged)) == figures(city_statistics(rows))


def test_large_ages_lose_no_digit(spark):
    rows = spark.createDataFrame([("d", "h", "b", "c", "s", 2_000_000_000 + n % 2) for n in range(1000)], SCHEMA)
    stddev = city_state.statistics_of_parts(city_state.city_parts(rows)).first().stddev_age
    assert stddev == pytest.approx(0.50025018, abs=1e-7)


def test_a_batch_in_both_views_counts_once_whatever_its_hour(spark):
    rows = events(spark)
    parts = city_state.city_parts(rows)
    held = parts.filter("hour < '03' or batch = 'q-1'")
    for speed in (parts, parts.filter("hour >= '03'")):
        assert figures(city_state.statistics_of_parts(city_state.merged_parts(held, speed))) == figures(city_statistics(rows))
    empty = spark.createDataFrame([], CITY_PARTS)
    assert city_state.merged_parts(empty, empty).count() == 0
    assert figures(city_state.statistics_of_parts(city_state.merged_parts(empty, parts))) == figures(city_statistics(rows))


def test_views_follow_late_batches_refreshes_and_trims(spark, people, tmp_path):
    lake, view, speed = (str(tmp_path / n) for n in ("lake", "view", "speed"))
    day, hour = 1_704_067_200_000, 3_600_000

    def write(batch, millis, *changes):
        rows = people(*changes).select("*", F.lit(millis).alias("eventTime"))
        append_to_lake(rows, lake, batch, speed)

    def check():
        merged = jobs.lambda_statistics(spark, view, speed).select(*city_statistics(read_lake(spark, lake)).columns)
        assert figures(merged) == figures(city_statistics(read_lake(spark, lake)))

    write("q-0", day, {"age": 20}, {"age": 40, "city": "Rome"})
    jobs.refresh_batch_view(spark, lake, view)
    check()
    write("q-1", day, {"age": 90})  # late: the hour is in the batch view
    write("q-2", day + 30 * hour, {"age": 30, "status": "Inactive"})
    check()
    write("q-1", day, {"age": 91}, {"age": 92})  # the batch is run again
    check()
    jobs.refresh_batch_view(spark, lake, view, "2024-01-01", "2024-01-01")
    check()
    assert jobs.trim_speed_view(spark, view, speed) == 2
    check()
    jobs.refresh_batch_view(spark, lake, view)
    jobs.refresh_batch_view(spark, lake, view)
    check()
