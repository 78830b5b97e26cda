import random
from datetime import datetime

import pytest

from rollcall.operators.runs import concatenate, lake_inventory, run_history, run_log_summary, running_total


def test_running_total_against_brute_force(spark):
    random.seed(3)
    # A third of the rows share one order value, so the tie-break carries the order.
    rows = [(0 if i % 3 == 0 else random.randrange(50), i, random.randrange(10)) for i in range(500)]
    df = spark.createDataFrame(rows, "t int, k int, v bigint").repartition(3)
    got = running_total(df, "v", "total", ("t", "k"), 7).collect()
    expected, so_far = {}, 0
    for t, k, v in sorted(rows):
        so_far += v
        expected[k] = so_far
    assert {r.k: r.total for r in got} == expected


def test_running_total_sorts_no_more_than_one_row_per_partition_in_one_task(spark):
    df = spark.range(100).selectExpr("id AS k", "id AS v")
    plan = running_total(df, "v", "total", ("k",), 5)._jdf.queryExecution().executedPlan().toString()
    # The only single-partition exchange takes the aggregated totals of the partitions.
    (below,) = plan.split("SinglePartition")[1:]
    assert "HashAggregate" in below.splitlines()[1]



def test_run_history_lists_empty_files_and_orders_by_time(spark):
    day = datetime(2024, 1, 1)
    files = spark.createDataFrame(
        [("b", day.replace(hour=2), 2048), ("a", day.replace(hour=3), 1023), ("c", day.replace(hour=1), 4096)],
        "path string, modificationTime timestamp, length bigint",
    )
    records = spark.createDataFrame([("a", 5), ("c", 7)], "path string, records bigint")
    rows = run_history(records, files, 2).orderBy("timestamp").collect()
    assert [(r.path, r.records, r.cumulative_total, r.size_kb) for r in rows] == [
        ("c", 7, 7, 4), ("b", 0, 7, 2), ("a", 5, 12, 0),
    ]


@pytest.mark.parametrize("sizes, expected", [([1000, 1100], (2, 2100, 2)), ([], (0, 0, 0))])
def test_lake_inventory(spark, sizes, expected):
    files = spark.createDataFrame([(s,) for s in sizes], "length bigint")
    assert tuple(lake_inventory(files).first()) == expected


def test_run_log_summary(spark):
    log = spark.createDataFrame(
        [("COMPLETED", 5, 10, 1), ("COMPLETED", 7, 20, 0), ("FAILED", 1, 0, 3), ("PENDING", 0, 0, 0)],
        "status string, duration bigint, records_processed bigint, records_failed bigint",
    )
    assert run_log_summary(log).first().asDict() == {
        "total": 4, "completed": 2, "failed": 1, "running": 0, "pending": 1,
        "total_duration": 13, "total_records": 30, "total_failed": 4,
    }
    empty = run_log_summary(log.limit(0)).first()
    assert (empty.total, empty.total_duration) == (0, 0)


def test_concatenate_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2, 7), (2, 7)], "n int, e bigint")
    rows = concatenate(a, b).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, "x", None), (2, None, 7), (2, None, 7)], key=str)
