import json

import pytest
from pyspark.sql import functions as F

from rollcall.operators.events import decode_events, to_events
from rollcall.operators.quality import SuccessRateTooLow
from rollcall.plans import jobs
from rollcall.sinks.event_log import publish_staged
from rollcall.sinks.files import write_lake
from rollcall.sinks.files import read_report_figures
from rollcall.sources.files import read_people

DAY = 1_704_067_200_000


def line(n, **changes):
    row = {
        "id": f"00000000-0000-4000-8000-{n:012d}", "name": f" P{n} ", "email": f"u{n}@test.com", "age": 30,
        "city": "NEW york", "status": "Active", "createdAt": "2024-01-01T00:00:00Z",
    }
    return json.dumps(row | changes)


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "in.jsonl"

    def write(*lines):
        path.write_text("\n".join(lines))
        return str(path)

    return write


def test_preprocess_normalises_and_counts_before_dropping(spark, source, tmp_path):
    path = source(line(1), line(2, name=" "), "", "{bad", line(3, age=150), line(4), line(5))
    written = jobs.preprocess(spark, path, str(tmp_path / "out"))
    assert (written.stats.total, written.stats.successful, written.stats.failed) == (6, 3, 3)
    good = read_people(spark, written.accepted).collect()
    assert {(r.name, r.city) for r in good} == {("P1", "New york"), ("P4", "New york"), ("P5", "New york")}
    bad = {r.error: r.value for r in spark.read.parquet(written.rejected).collect()}
    assert bad["Parse error: malformed JSON"] == "{bad"
    assert f"Empty name for person 00000000-0000-4000-8000-{2:012d}" in bad
    assert bad["Parse error: Invalid age: 150 (must be between 0 and 150)"] == line(3, age=150)


def test_preprocess_stops_below_the_rate(spark, source, tmp_path):
    path = source(line(1), "{bad", "{bad")
    with pytest.raises(SuccessRateTooLow):
        jobs.preprocess(spark, path, str(tmp_path / "out"))
    assert jobs.preprocess(spark, path, str(tmp_path / "out"), None).stats.failed == 2


def test_check_lines_writes_nothing(spark, source, tmp_path):
    before = set(tmp_path.rglob("*"))
    row = jobs.check_lines(spark, source(line(1), "{bad"), "value").first()
    assert (row.total, row.successful, row.success_rate) == (2, 1, 50.0)
    assert list(row.sample_errors) == ["Parse error: malformed JSON"]
    assert len(set(tmp_path.rglob("*")) - before) == 1


def test_publish_file_reports_what_it_drops(spark, source, tmp_path):
    topic = str(tmp_path / "topic")
    counts, dropped = jobs.publish_file(
        spark, source(line(1, name=" "), "{bad", line(2)), lambda m: publish_staged(m, topic), F.lit(DAY)
    )
    assert (counts.success, counts.failure, dropped) == (2, 0, 1)
    rows = decode_events(spark.read.parquet(topic)).orderBy("id").collect()
    # Neither the name rule nor normalising applies here.
    assert [(r.name, r.city, r.eventTime) for r in rows] == [(" ", "NEW york", DAY), (" P2 ", "NEW york", DAY)]
    messages, undecodable = jobs.messages_from_file(spark, source("{bad", line(2)), F.lit(DAY))
    assert (messages.count(), undecodable.count()) == (1, 1)


def test_batch_analytics_counts_rows_once(spark, people, tmp_path):
    lake = str(tmp_path / "lake")
    write_lake(to_events(people({}, {"city": "Rome"}, {}), F.lit(DAY)), lake)
    records, sample = jobs.batch_analytics(spark, lake, str(tmp_path / "stats"))
    assert records == 3
    assert sample.columns == ["name", "age", "city", "age_group", "email_domain"] and sample.count() == 3
    stats = spark.read.parquet(str(tmp_path / "stats")).collect()
    assert [(r.city, r.total_people) for r in stats] == [("Paris", 2), ("Rome", 1)]
    assert jobs.enriched_lake(spark, lake).filter("is_active").count() == 3


def test_platform_run_from_generation_to_history(spark, tmp_path):
    lake, output = str(tmp_path / "lake"), str(tmp_path / "report")
    for run in range(2):
        profile = jobs.generate(spark, lake, 100, F.lit(DAY + run * 3_600_000)).first()
        assert profile.asDict() == {"records": 100, "unique_cities": 6, "age_range": "18 - 67"}
    inventory, validation = jobs.validate(spark, lake)
    assert validation.first().asDict() == {
        "records_read": 200, "valid": 200, "invalid": 0, "dropped": 0, "blank_names": 0,
    }
    jobs.analyze(spark, lake, output)
    assert read_report_figures(spark, output).filter("section = 'report'").first()["count"] == 200
    history = jobs.export_history(spark, lake).orderBy("timestamp", "path").collect()
    assert len(history) == inventory.first().files
    assert history[-1].cumulative_total == 200 == sum(r.records for r in history)


def test_generated_lines_and_messages(spark, tmp_path):
    lines, topic = str(tmp_path / "lines"), str(tmp_path / "topic")
    jobs.write_generated_lines(spark, lines, 30)
    assert jobs.preprocess(spark, lines, str(tmp_path / "out")).stats.successful == 30
    counts = jobs.publish_generated(spark, lambda m: publish_staged(m, topic), 20)
    assert (counts.success, counts.failure) == (20, 0)
    assert decode_events(spark.read.parquet(topic)).filter("error is null").count() == 20
