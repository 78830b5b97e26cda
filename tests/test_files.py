import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rollcall.operators.events import to_events
from rollcall.operators.processor import check, process, storage_spec
from rollcall.operators.report import report_figures
from rollcall.operators.runs import run_log_summary
from rollcall.operators.statistics import city_statistics, combined_report
from rollcall.schemas import PERSON_FIELDS
from rollcall.sinks import files as sink
from rollcall.sources import files as source
from rollcall.sources.generator import generate_people, people_from_index

HOUR = 3_600_000
DAY = 1_704_067_200_000  # 2024-01-01


def folders(path):
    return sorted(str(p.parent.relative_to(path)) for p in Path(path).rglob("*.parquet"))


def test_json_lines_skip_blank_lines(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"a":1}\n\n \t\n{"a":2}\n', encoding="utf-8")
    assert source.read_json_lines(spark, str(tmp_path)).count() == 2


def test_json_lines_replace_what_is_there(spark, people, tmp_path):
    path = str(tmp_path / "out")
    sink.write_json_lines(people({}, {}), path)
    sink.write_json_lines(people({"name": None}), path, *PERSON_FIELDS)
    (line,) = [r.value for r in spark.read.text(path).collect()]
    assert json.loads(line)["name"] is None and list(json.loads(line)) == list(PERSON_FIELDS)


def test_parquet_is_checked_again_on_reading(spark, people, tmp_path):
    path = str(tmp_path / "people")
    people({"city": " Rome "}, {"age": 150}, {"name": ""}).write.parquet(path)
    rows = source.read_people(spark, path).orderBy("id").collect()
    assert [(r.city, r.name) for r in rows] == [("Rome", "Person 1"), ("Paris", "")]
    assert source.read_records(spark, path).count() == 3


def test_typed_write_is_canonical(spark, people, tmp_path):
    path = str(tmp_path / "people")
    sink.write_people(people({"status": "Suspended:x:"}), path)
    assert spark.read.parquet(path).first().status == "Suspended:x"


def test_split_write_counts_and_separates_in_one_pass(spark, people, tmp_path):
    path = str(tmp_path / "split")
    processed = process(people({}, {"age": 150}, {"city": " Rome"}), storage_spec())
    written = sink.write_split(processed, path)
    assert (written.stats.total, written.stats.successful, written.stats.failed) == (3, 2, 1)
    assert source.read_people(spark, written.accepted).count() == 2
    assert spark.read.parquet(written.rejected).first().error.startswith("Invalid age: 150")


def test_statistics_overwrite(spark, people, tmp_path):
    path = str(tmp_path / "stats")
    for df in (people({}, {"city": "Rome"}), people({})):
        sink.write_statistics(city_statistics(df), path)
    assert [r.total_people for r in spark.read.parquet(path).collect()] == [1]


@pytest.fixture
def lake(people, tmp_path):
    path = str(tmp_path / "lake")
    events = to_events(people({}, {}, {}), F.lit(DAY) + F.col("age").cast("bigint") * 0)
    hours = F.when(F.col("id").endswith("1"), 9 * HOUR).when(F.col("id").endswith("2"), 33 * HOUR).otherwise(0)
    sink.write_lake(events.withColumn("eventTime", F.col("eventTime") + hours), path)
    return path


def test_lake_layout_keeps_text_partitions(spark, lake):
    assert [f.rpartition("/batch=")[0] for f in folders(lake)] == [
        "dt=2024-01-01/hour=00", "dt=2024-01-01/hour=09", "dt=2024-01-02/hour=09"
    ]
    rows = source.read_lake(spark, lake).collect()
    assert sorted({(r.dt, r.hour) for r in rows}) == [("2024-01-01", "00"), ("2024-01-01", "09"), ("2024-01-02", "09")]


def test_lake_bounds_prune_partitions(spark, lake):
    bounded = source.read_lake(spark, lake, dt_from="2024-01-02", dt_to="2024-01-02")
    assert [r.dt for r in bounded.collect()] == ["2024-01-02"]
    plan = bounded.select("age")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<age:int>" in plan


def test_a_landed_batch_joins_the_lake(spark, people, lake):
    sink.land_batch(people({"city": "Rome"}), lake, F.lit(DAY + 5 * HOUR))
    landed = source.read_lake(spark, lake).filter("city = 'Rome'").first()
    assert (landed.dt, landed.hour, landed.eventTime) == ("2024-01-01", "05", DAY + 5 * HOUR)


def test_both_layouts_below_one_root(spark, people, lake):
    people({}, {}).withColumn("dt", F.lit("2023-12-31")).write.mode("append").partitionBy("dt").parquet(lake)
    rows = source.scan_data_files(spark, lake).collect()
    legacy = [r for r in rows if r.hour is None]
    assert len(rows) == 5 and len(legacy) == 2
    assert {r.dt for r in legacy} == {"2023-12-31"} and {r.eventTime for r in legacy} == {None}
    counted = source.readable_by_file(source.scan_data_files(spark, lake)).collect()
    assert sum(r.records for r in counted) == 5
    listed = {r.path for r in source.list_data_files(spark, lake).collect()}
    assert {r.path for r in counted} == listed


def test_legacy_lake_has_no_hour(spark, people, tmp_path):
    path = str(tmp_path / "legacy")
    people({}).withColumn("dt", F.lit("2024-01-01")).write.partitionBy("dt").parquet(path)
    assert source.read_legacy_lake(spark, path).first().dt == "2024-01-01"
    assert source.read_legacy_lake(spark, path, dt_from="2024-01-02").count() == 0


def test_absent_root_is_empty(spark, tmp_path):
    missing = str(tmp_path / "nothing")
    assert source.scan_data_files(spark, missing).count() == 0
    assert source.list_data_files(spark, missing).count() == 0


def test_file_listing_reads_no_contents(spark, lake):
    plan = source.list_data_files(spark, lake)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_report_round_trip_replaces_what_is_there(spark, people, tmp_path):
    path = str(tmp_path / "report")
    sink.write_report(combined_report(people({}, {"city": "Oslo"}, {"city": None}, {"city": ""})), path, F.lit("old"))
    df = people({}, {"city": "Rome", "age": 70}, {"status": "Suspended:x"})
    sink.write_report(combined_report(df), path, F.lit("2024-01-01T00:00:00"))
    figures = {(r.section, r.key): (r["count"], r.percentage) for r in sink.read_report_figures(spark, path).collect()}
    assert figures == {
        ("report", "2024-01-01T00:00:00"): (3, None),
        ("city", "Paris"): (2, None), ("city", "Rome"): (1, None),
        ("age_group", "Adult"): (2, "66.7%"), ("age_group", "Senior"): (1, "33.3%"),
        ("status", "Active"): (2, None), ("status", "Suspended:x"): (1, None),
        ("domain", "test.com"): (3, None),
    }


def test_null_and_empty_keys_stay_apart(spark, people, tmp_path):
    path = str(tmp_path / "report")
    sink.write_report(combined_report(people({"city": None}, {"city": ""}, {"city": ""})), path)
    rows = sink.read_report_figures(spark, path).filter("section = 'city'").collect()
    assert {r.key: r["count"] for r in rows} == {None: 1, "": 2}


def test_pretty_printed_report_is_read_too(spark, tmp_path):
    text = json.dumps({"total_records": 2, "city_statistics": [{"city": "X", "total_people": 2}]}, indent=2)
    (tmp_path / "analytics.json").write_text(text)
    report = source.read_report(spark, str(tmp_path / "analytics.json")).first()
    assert report.total_records == 2 and report.city_statistics[0].city == "X" and report.age_groups is None


def test_report_of_nobody(spark, people, tmp_path):
    path = str(tmp_path / "report")
    sink.write_report(combined_report(people({}).limit(0)), path)
    rows = sink.read_report_figures(spark, path).collect()
    assert [(r.section, r["count"]) for r in rows] == [("report", 0)]


def test_a_split_without_one_side_reads_it_as_empty(spark, people, tmp_path):
    for good, change in ((2, {}), (0, {"age": 200})):
        checked = check(people(change, change), storage_spec())
        written = sink.write_split(checked, str(tmp_path / f"split{good}"))
        assert written.read(spark, sink.ACCEPTED).count() == good
        assert written.read(spark, sink.REJECTED).count() == 2 - good


def test_generated_people(spark):
    rows = generate_people(spark, 50).orderBy("age", "name").collect()
    assert len(rows) == 50 and min(r.age for r in rows) == 18 and max(r.age for r in rows) == 67
    ann = next(r for r in rows if r.name.endswith("-9"))
    assert (ann.name, ann.email, ann.age, ann.city, ann.status) == (
        "Bob Smith-9", "user9@example.com", 27, "Austin", "Pending",
    )
    again = generate_people(spark, 50).orderBy("age", "name").collect()
    assert [r.id for r in rows] == [r.id for r in again] and len({r.id for r in rows}) == 50


def test_generated_people_are_valid_and_meet_one_domain_per_city(spark):
    people = people_from_index(spark.range(1, 200), "id")
    assert check(people, storage_spec()).filter("error is not null").count() == 0
    pairs = people.select("city", F.element_at(F.split("email", "@"), -1)).distinct()
    assert pairs.count() == 6


def test_run_log_documents(spark, tmp_path):
    run = {
        "taskId": "t", "status": "COMPLETED", "startTime": "2024-01-01T00:00:00Z", "endTime": None, "duration": 5,
        "recordsProcessed": 10, "recordsFailed": 1, "taskData": {"Format": "Parquet"}, "sampleData": [{"name": "A"}],
        "logs": [{"timestamp": "2024-01-01T00:00:00Z", "message": "Task started", "level": "INFO"}], "error": None,
    }
    (tmp_path / "runs.json").write_text(json.dumps([run, run | {"status": "FAILED"}], indent=1))
    log = source.read_run_log(spark, str(tmp_path / "runs.json"))
    row = log.filter("status = 'COMPLETED'").first()
    assert row.start_time.year == 2024 and row.end_time is None and row.task_data == {"Format": "Parquet"}
    assert run_log_summary(log).first().asDict() == {
        "total": 2, "completed": 1, "failed": 1, "running": 0, "pending": 0,
        "total_duration": 10, "total_records": 20, "total_failed": 2,
    }


def test_an_oversized_hour_is_split_over_writers(spark, tmp_path):
    """All rows share one hour; rebalancing gives it several tasks once it is too big for one."""
    path = str(tmp_path / "lake")
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    people = generate_people(spark, 20000).repartition(8)
    spark.conf.set(setting, "64KB")
    try:
        sink.write_lake(to_events(people, F.lit(DAY)), path)
    finally:
        spark.conf.unset(setting)
    files = list(Path(path).rglob("*.parquet"))
    assert {p.parent.parent.name for p in files} == {"hour=00"} and len(files) > 2
    assert source.read_lake(spark, path).count() == 20000


def test_many_reports_are_unfolded_side_by_side(spark, tmp_path):
    whole = {
        "generated_at": "t", "total_records": 2,
        "city_statistics": [{"city": "X", "total_people": 2, "avg_age": 1.5, "min_age": 1, "max_age": 2}],
        "age_groups": [{"age_group": "Minor", "count": 2, "percentage": "100.0%"}],
        "status_distribution": {"Active": 2}, "email_domains": {"test.com": 1, "demo.org": 1},
    }
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.json").write_text(json.dumps(whole, indent=2))
    (tmp_path / "deep" / "b.json").write_text(json.dumps({"age_groups": [], "status_distribution": {"Gone": 7}}))
    (tmp_path / "c.json").write_text('{"total_records": ')
    rows = report_figures(source.read_reports(spark, str(tmp_path))).collect()
    by_source = {}
    for r in rows:
        by_source.setdefault(Path(r.source).name, set()).add(tuple(r)[2:])
    assert by_source["a.json"] == {
        ("total", None, 2, None, None, None, None), ("city", "X", 2, 1.5, 1, 2, None),
        ("age_group", "Minor", 2, None, None, None, "100.0%"), ("status", "Active", 2, None, None, None, None),
        ("domain", "test.com", 1, None, None, None, None), ("domain", "demo.org", 1, None, None, None, None),
    }
    none = (None,) * 4
    assert by_source["b.json"] == {("total", None, 0, *none), ("status", "Gone", 7, *none)}
    assert by_source["c.json"] == {("unreadable", None, None, *none)}
