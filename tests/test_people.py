from pyspark.sql import functions as F

from rollcall.functions import people as P
from rollcall.operators import people as ops




def test_age_group(evaluate):
    ages = [17, 18, 29, 30, 49, 50, 64, 65, None]
    groups = ["Minor"] + ["Young Adult"] * 2 + ["Adult"] * 2 + ["Middle Age"] * 2 + ["Senior"] * 2
    assert evaluate(P.age_group, ages, "int") == groups


def test_age_category(evaluate):
    ages = [12, 13, 19, 20, 64, 65]
    assert evaluate(P.age_category, ages, "int") == ["child", "teen", "teen", "adult", "adult", "senior"]


def test_adult_and_minor_are_complements(evaluate):
    assert evaluate(P.is_adult, [17, 18], "int") == [False, True]
    assert evaluate(P.is_minor, [17, 18], "int") == [True, False]


def test_email_parts(evaluate):
    emails = ["a@b", "abc", "user@", None, "a@b@c"]
    assert evaluate(P.email_domain, emails) == ["b", None, "", None, "b"]
    assert evaluate(P.email_username, emails) == ["a", "abc", "user", None, "a"]


def test_domain_with_fallback(evaluate):
    emails = ["abc", "@", "@@@", "user@", "a@b@c", "a@b", "@x", "", None]
    domains = ["abc", "unknown", "unknown", "user", "c", "b", "x", "", None]
    assert evaluate(P.domain_or_unknown, emails) == domains


def test_flags(evaluate):
    states = ["Active", "Pending", "Suspended:x", None]
    assert evaluate(P.is_active, states) == [True, False, False, None]
    assert evaluate(P.is_available, states) == [True, True, False, None]


def test_categorize(people):
    df = people(
        {"age": 10}, {"age": 30}, {"status": "Suspended:x"}, {"status": "Pending"}, {"status": "Inactive"},
        {"age": 10, "status": "Suspended:x"},
    )
    rows = ops.categorize(df).orderBy("id").select("category").collect()
    assert [r[0] for r in rows] == ["Minor", "Active Adult", "Suspended: x", "Other", "Other", "Minor"]


def test_anonymize_keeps_everything_else(people):
    row = ops.anonymize(people({"id": "abcdef12-0000-4000-8000-000000000001"})).first()
    assert (row.name, row.email) == ("User-abcdef12", "anonymous@example.com")
    assert (row.age, row.city, row.status) == (30, "Paris", "Active")


def test_summary_shows_the_storage_status(people):
    row = ops.summarize(people({"status": "Suspended:late:"})).first()
    assert row.summary == "Person 1 (30yo, Paris) - Suspended:late"


def test_enrich_adds_four_columns_in_one_projection(people):
    enriched = ops.enrich(people({}, {"email": "none", "age": None, "status": None}))
    first, second = enriched.orderBy("id").collect()
    assert (first.age_group, first.email_domain, first.name_length, first.is_active) == (
        "Adult", "test.com", 8, True,
    )
    assert (second.age_group, second.email_domain, second.is_active) == ("Senior", None, None)


def test_with_status_and_normalize(people):
    df = people({"name": " Ann\t", "city": " NEW york"})
    row = ops.with_status(ops.normalize(df), "Inactive").first()
    assert (row.name, row.city, row.status) == ("Ann", "New york", "Inactive")


def test_to_storage_is_canonical(people):
    df = people({"id": "1-2-3-4-5", "status": "SuspendedX:a:", "createdAt": "2024-01-01T01:00:00+01:00"})
    row = ops.to_storage(df.withColumn("extra", F.lit(1))).first()
    assert row.asDict() == {
        "id": "00000001-0002-0003-0004-000000000005", "name": "Person 1", "email": "user1@test.com", "age": 30,
        "city": "Paris", "status": "Suspended:a", "createdAt": "2024-01-01T00:00:00Z",
    }


def test_samples_are_top_k(people):
    df = people(*[{} for _ in range(12)])
    assert ops.enriched_sample(df).count() == 10 and ops.batch_sample(df).count() == 5
    plan = ops.enriched_sample(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
