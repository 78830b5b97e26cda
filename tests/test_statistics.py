import math
import random
from collections import Counter

import pytest

from rollcall.functions.people import AGE_GROUPS
from rollcall.operators import statistics as S


def group_of(age):
    return next((label for bound, label in AGE_GROUPS if age is not None and age < bound), "Senior")


@pytest.fixture(scope="module")
def crowd(spark):
    """A third of the rows share one city and domain."""
    random.seed(7)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        city = "Hot" if hot else f"City {random.randrange(20)}"
        domain = "hot.org" if hot else f"d{random.randrange(30)}.com"
        status = random.choice(["Active", "Inactive", "Pending", "Suspended:a", "Suspended:b"])
        rows.append((f"{i}", f"P{i}", f"u{i}@{domain}", random.randrange(150), city, status, "2024-01-01T00:00:00Z"))
    return rows


@pytest.fixture(scope="module")
def crowd_df(spark, crowd):
    schema = "id string, name string, email string, age int, city string, status string, createdAt string"
    return spark.createDataFrame(crowd, schema).repartition(4)


def test_city_statistics_against_brute_force(crowd, crowd_df):
    rows = S.city_statistics(crowd_df).collect()
    assert [r.total_people for r in rows] == sorted((r.total_people for r in rows), reverse=True)
    assert rows[0].city == "Hot"
    for r in rows:
        ages = [p[3] for p in crowd if p[4] == r.city]
        mean = sum(ages) / len(ages)
        deviation = math.sqrt(sum((a - mean) ** 2 for a in ages) / (len(ages) - 1))
        assert (r.total_people, r.min_age, r.max_age) == (len(ages), min(ages), max(ages))
        assert r.avg_age == pytest.approx(mean) and r.stddev_age == pytest.approx(deviation)
        assert r.distinct_statuses == len({p[5] for p in crowd if p[4] == r.city})


def test_single_person_city_has_no_deviation_and_null_status_is_not_counted(people):
    row = S.city_statistics(people({"status": None})).first()
    assert row.stddev_age is None and row.distinct_statuses == 0 and row.total_people == 1


def test_ties_are_ordered_by_city(people):
    rows = S.city_statistics(people({"city": "B"}, {"city": "A"})).collect()
    assert [r.city for r in rows] == ["A", "B"]


def test_city_statistics_reduce_before_each_shuffle(crowd_df):
    plan = S.city_statistics(crowd_df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and "Expand" not in plan and "Window" not in plan


def test_report_parts_against_the_combined_report(crowd, crowd_df):
    report = S.combined_report(crowd_df).collect()
    sections = Counter(r.section for r in report)
    assert sections["total"] == 1 and sections["city"] == 21 and sections["domain"] == 31
    assert sum(r["count"] for r in report if r.section == "age_group") == len(crowd)

    def part(section):
        return {r.key: r for r in report if r.section == section}

    cities = part("city")
    for r in S.city_report(crowd_df).collect():
        entry = cities[r.city]
        assert (r.total_people, r.avg_age, r.min_age, r.max_age) == (
            entry["count"], entry.avg_age, entry.min_age, entry.max_age,
        )
    groups = part("age_group")
    for r in S.age_group_distribution(crowd_df).collect():
        assert (r["count"], r.percentage) == (groups[r.age_group]["count"], groups[r.age_group].percentage)
    expected = Counter(group_of(p[3]) for p in crowd)
    assert {k: r["count"] for k, r in groups.items()} == expected
    statuses = {r.status: r["count"] for r in S.status_distribution(crowd_df).collect()}
    assert statuses == {k: r["count"] for k, r in part("status").items()} == Counter(p[5] for p in crowd)
    domains = {r.domain: r["count"] for r in S.domain_distribution(crowd_df).collect()}
    assert domains == {k: r["count"] for k, r in part("domain").items()}


def test_combined_report_is_one_scan_and_one_shuffle(crowd_df, tmp_path, spark):
    crowd_df.write.parquet(str(tmp_path / "people"))
    report = S.combined_report(spark.read.parquet(str(tmp_path / "people")))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan and "Window" not in plan


def test_one_decimal_rounds_halves_up(people):
    rows = S.city_report(people({"age": 12}, {"age": 12}, {"age": 12}, {"age": 13})).collect()
    assert rows[0].avg_age == 12.3


def test_percentages(people):
    rows = S.age_group_distribution(people({"age": 1}, {"age": 30}, {"age": 31})).collect()
    assert [(r.age_group, r["count"], r.percentage) for r in rows] == [("Adult", 2, "66.7%"), ("Minor", 1, "33.3%")]


def test_empty_input(people):
    nobody = people({}).limit(0)
    assert S.age_group_distribution(nobody).collect() == []
    assert S.record_count(nobody).first().total_records == 0
    assert S.city_statistics(nobody).collect() == []


def test_batch_profile(people):
    row = S.batch_profile(people({"age": 5}, {"age": 70, "city": "Rome"}, {})).first()
    assert row.asDict() == {"records": 3, "unique_cities": 2, "age_range": "5 - 70"}


def test_a_city_without_ages_has_no_average(people):
    rows = {r.city: r.avg_age for r in S.city_report(people({"city": "A", "age": None}, {"city": "B", "age": 4})).collect()}
    assert rows == {"A": None, "B": 4.0}
    report = {(r.section, r.key): r.avg_age for r in S.combined_report(people({"city": "A", "age": None})).collect()}
    assert report["city", "A"] is None


def test_a_report_of_nobody_says_so(people):
    rows = S.combined_report(people({}).limit(0)).collect()
    assert [(r.section, r["count"]) for r in rows] == [("total", 0)]
