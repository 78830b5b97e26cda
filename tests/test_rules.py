import pytest

from rollcall.functions import clock, rules, text




def test_email_rule(evaluate):
    good = ["a@b.co", "a.b+c_d-e@x-y.example.org"]
    bad = ["a@b.co\n", "a@b", "@b.co", "a b@c.co", "a@@b.co", "", "a@b.c"]
    errors = evaluate(rules.email_error, good + bad + [None])
    assert errors == [None] * 2 + [f"Invalid email format: {e}" for e in bad] + ["Missing email"]


def test_age_rule_excludes_the_upper_bound(evaluate):
    bad = "Invalid age: {} (must be between 0 and 150)"
    errors = evaluate(rules.age_error, [0, 149, -1, 150, None], "int")
    assert errors == [None, None, bad.format(-1), bad.format(150), "Missing age"]


def test_city_rule_counts_utf16_units(evaluate):
    values = ["\tParis ", "x" * 100, " " + "x" * 100 + "\n", "", " \t", "x" * 101, None]
    values += ["\U0001f600" * 50, "\U0001f600" * 51]
    errors = evaluate(rules.city_error, values)
    assert [e is None for e in errors] == [True, True, True, False, False, False, False, True, False]
    assert errors[4] == "Invalid city: ' \t'" and errors[6] == "Missing city"


def test_status_rule(evaluate):
    good = ["Active", "Inactive", "Pending", "Suspended:x", "Suspended:a:", "SuspendedX:a", "Suspended:a::"]
    suspended = ["Suspended", "Suspended:", "Suspended:a:b", "Suspended::a", "Suspended::"]
    unknown = ["active", "Gone", "", "Active "]
    errors = evaluate(rules.status_error, good + suspended + unknown + [None])
    assert errors[: len(good)] == [None] * len(good)
    assert errors[len(good) : -5] == [f"Invalid suspended format: {s}" for s in suspended]
    assert errors[-5:-1] == [f"Unknown status: {s}" for s in unknown]
    assert errors[-1] == "Missing status"


def test_status_storage_form_and_reason(evaluate):
    values = ["Active", "Suspended:x", "Suspended:a:", "SuspendedX:a", "Gone", None]
    stored = ["Active", "Suspended:x", "Suspended:a", "Suspended:a", "Gone", None]
    assert evaluate(rules.storage_status, values) == stored
    assert evaluate(rules.suspend_reason, values) == [None, "x", "a", "a", None, None]


UUIDS = {
    "00000000-0000-4000-8000-00000000000a": "00000000-0000-4000-8000-00000000000a",
    "ABCDEF01-0000-4000-8000-00000000000A": "abcdef01-0000-4000-8000-00000000000a",
    "1-2-3-4-5": "00000001-0002-0003-0004-000000000005",
    # Digits beyond a group's width are cut from the left.
    "123456789-2-3-4-5": "23456789-0002-0003-0004-000000000005",
    "+1-2-3-4-5": "00000001-0002-0003-0004-000000000005",
    "0000000000000000001-2-3-4-5": "00000001-0002-0003-0004-000000000005",
    "7fffffffffffffff-2-3-4-5": "ffffffff-0002-0003-0004-000000000005",
}
BAD_UUIDS = [
    "", "not-a-uuid", "1-2-3-4", "1-2-3-4-5-6", "1-2-3-4-", "g-2-3-4-5", "1--3-4-5", "1-2-3-4-5\n",
    "8000000000000000-2-3-4-5", "00000000-0000-4000-8000-0000000000000", "{1-2-3-4-5}",
]


def test_id_rule_and_canonical_form(evaluate):
    errors = evaluate(rules.id_error, [*UUIDS, *BAD_UUIDS, None])
    assert errors == [None] * len(UUIDS) + [f"Invalid UUID: {u}" for u in BAD_UUIDS] + ["Missing id"]
    assert evaluate(rules.canonical_id, list(UUIDS)) == list(UUIDS.values())


INSTANTS = {
    "2024-01-01T00:00:00Z": "2024-01-01T00:00:00Z",
    "2024-01-01t00:00:00z": "2024-01-01T00:00:00Z",
    "2024-02-29T23:59:59.5Z": "2024-02-29T23:59:59.500Z",
    "2024-01-01T10:00:00.500+02:00": "2024-01-01T08:00:00.500Z",
    "2024-01-01T00:30:00+01:00": "2023-12-31T23:30:00Z",
    "2024-01-01T00:00:00.000Z": "2024-01-01T00:00:00Z",
    "2024-01-01T00:00:00.123456Z": "2024-01-01T00:00:00.123456Z",
    "2024-01-01T00:00:00.123456789Z": "2024-01-01T00:00:00.123456789Z",
    "1969-12-31T23:59:58Z": "1969-12-31T23:59:58Z",
}
BAD_INSTANTS = [
    "", "yesterday", "2024-01-01", "2024-01-01T00:00:00", "2024-13-01T00:00:00Z", "2024-02-30T00:00:00Z",
    "2024-01-01 00:00:00Z", "2024-01-01T00:00Z", "2024-01-01T00:00:00Z ", "2024-01-01T25:00:00Z",
]


def test_timestamp_rule_and_canonical_form(evaluate):
    errors = evaluate(rules.created_at_error, [*INSTANTS, *BAD_INSTANTS, None])
    bad = [f"Invalid timestamp: {t}" for t in BAD_INSTANTS]
    assert errors == [None] * len(INSTANTS) + bad + ["Missing createdAt"]
    assert evaluate(clock.instant_text, list(INSTANTS)) == list(INSTANTS.values())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_helpers_ignore_the_session_zone(spark, evaluate, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert evaluate(clock.instant_text, list(INSTANTS)) == list(INSTANTS.values())
        millis = [1735311600000, 0, -1]
        assert evaluate(clock.partition_date, millis, "bigint") == ["2024-12-27", "1970-01-01", "1969-12-31"]
        assert evaluate(clock.partition_hour, millis, "bigint") == ["15", "00", "23"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_business_rules(spark):
    df = spark.createDataFrame([(" \t", "i1", 5), ("Bob", "i2", -1), ("Bob", "i3", 1)], "name string, id string, age int")
    errors = df.orderBy("id").select(rules.first_error(*rules.business_errors().values())).collect()
    assert [e[0] for e in errors] == ["Empty name for person i1", "Negative age for Bob", None]


def test_normal_city_touches_only_the_first_letter(evaluate):
    values = ["  NEW york ", "\tparis", "san FRANCISCO", "", "élan", "ßtadt", None]
    normal = ["New york", "Paris", "San francisco", "", "Élan", "ßtadt", None]
    assert evaluate(rules.normal_city, values) == normal
    assert evaluate(lambda c: rules.normal_city(rules.normal_city(c)), values) == normal


def test_trim_takes_control_characters_but_no_other_blanks(evaluate):
    values = ["\x00\t a b \r\n", " x ", ""]
    assert evaluate(text.jvm_trim, values) == ["a b", " x ", ""]


def test_whole_number(evaluate):
    values = ["7", "-3", "3.0", "3.", "3.5", "x", "", "99999999999999999999", "1704067200000", None]
    assert evaluate(text.whole_number, values) == [7, -3, 3, 3, None, None, None, None, 1704067200000, None]
