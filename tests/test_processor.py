import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators import processor
from rollcall.operators.processor import RecordSpec, accepted, check, parse_people, process, rejected
from rollcall.operators.quality import (
    ProcessingStats,
    SuccessRateTooLow,
    processing_stats,
    rejects_by_rule,
    validate_lake,
)

GOOD = {
    "id": "00000000-0000-4000-8000-000000000001", "name": "Ann", "email": "a@b.co", "age": 20,
    "city": " Paris", "status": "Suspended:x:", "createdAt": "2024-01-01T00:00:00Z",
}


def parsed(spark, *lines):
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    return parse_people(df).orderBy("i").collect()


def test_first_error_wins_and_names_are_not_checked(people):
    df = people({}, {"email": "x", "city": " "}, {"name": " "}, {"id": "x", "email": None})
    rows = check(df, processor.storage_spec()).orderBy("name").select("name", "error", "error_rule").collect()
    assert {r.name: (r.error, r.error_rule) for r in rows} == {
        "Person 1": (None, None),
        "Person 2": ("Invalid email format: x", "email"),
        " ": (None, None),
        "Person 4": ("Invalid UUID: x", "id"),
    }


def test_good_and_bad_rows_make_up_the_input(people):
    df = people({}, {"age": 150}, {"status": "Gone"}, {})
    checked = check(df, processor.storage_spec())
    good, bad = accepted(checked, processor.storage_spec()), rejected(checked)
    assert (good.count(), bad.count()) == (2, 2)
    assert good.columns == df.columns


def test_a_spec_serves_any_table(spark):
    spec = RecordSpec(
        ("sku", "price"),
        {"price": F.when(F.col("price") <= 0, "not positive"), "sku": F.when(F.col("sku") == "", "no sku")},
        {"sku": F.upper("sku")},
    )
    df = spark.createDataFrame([("a", 1), ("b", 0), ("", 0), ("", 5)], "sku string, price int")
    rows = [tuple(r) for r in process(df, spec).collect()]
    assert sorted(rows) == sorted(
        [("A", 1, None, None), ("b", 0, "not positive", "price"), ("", 0, "not positive", "price"), ("", 5, "no sku", "sku")]
    )


def test_rules_run_without_python_workers(people):
    checked = check(people({}), processor.storage_spec())
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_parse_gives_canonical_people(spark):
    row = parsed(spark, GOOD | {"unknown": [1, 2]})[0]
    assert (row.error, row.city, row.status, row.age) == (None, "Paris", "Suspended:x", 20)


@pytest.mark.parametrize("field", list(GOOD))
def test_parse_needs_every_field(spark, field):
    absent = {k: v for k, v in GOOD.items() if k != field}
    rows = parsed(spark, absent, GOOD | {field: None})
    assert [r.error for r in rows] == [f"Parse error: Missing {field}"] * 2


def test_parse_errors(spark):
    rows = parsed(
        spark, "{bad", "[1]", "7", GOOD | {"age": 2.5}, GOOD | {"age": "7"}, GOOD | {"age": 3.0},
        GOOD | {"age": 150}, GOOD | {"age": 99999999999}, GOOD | {"email": "x", "age": -1},
    )
    errors = [r.error for r in rows]
    assert errors[:3] == ["Parse error: malformed JSON"] * 3
    assert errors[3] == "Parse error: Invalid age: 2.5"
    assert errors[4:6] == [None, None] and [rows[4].age, rows[5].age] == [7, 3]
    assert errors[6] == "Parse error: Invalid age: 150 (must be between 0 and 150)"
    assert errors[7] == "Parse error: Invalid age: 99999999999"
    assert errors[8] == "Parse error: Invalid email format: x"


def test_a_line_holds_one_object_and_nothing_else(spark):
    one = json.dumps(GOOD)
    rows = parsed(spark, one + " x", one + one, f"{one},{one}", "null", "[]", f"[{one}]", "", f"  {one}\t")
    assert [r.error for r in rows] == ["Parse error: malformed JSON"] * 7 + [None]


def test_json_is_decoded_once_per_row(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    good = parse_people(lines).filter("error is null").select("id", "city")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_create_people(spark):
    df = spark.createDataFrame(
        [(" Ann ", "a@b.co", 20, " Paris"), ("  ", "a@b.co", 20, "Paris"), ("Bob", "x", 200, "")],
        "name string, email string, age int, city string",
    )
    rows = {r.email + r.name: r for r in processor.create_people(df).collect()}
    ann, blank, bob = rows["a@b.coAnn"], rows["a@b.co"], rows["xBob"]
    assert (ann.city, ann.status, ann.error) == ("Paris", "Pending", None)
    assert blank.name == "" and blank.error is None
    assert bob.error == "Invalid email format: x"
    assert ann.id != blank.id and len(ann.id) == 36


def test_created_people_pass_the_record_rules(spark):
    df = spark.createDataFrame([("Ann", "a@b.co", 20, "Paris")], "name string, email string, age int, city string")
    created = processor.create_people(df).drop("error", "error_rule")
    assert check(created, processor.storage_spec()).first().error is None


def test_processing_stats(people):
    df = people({}, {"age": 150}, {"age": -1}, {"age": 151}, {"age": 152})
    row = processing_stats(check(df, processor.storage_spec()), "id").first()
    assert (row.total, row.successful, row.failed, row.success_rate) == (5, 1, 4, 20.0)
    assert [e.split()[2] for e in row.sample_errors] == ["150", "-1", "151"]


def test_processing_stats_without_rows(people):
    row = processing_stats(check(people({}).limit(0), processor.storage_spec()), "id").first()
    assert (row.total, row.failed, row.success_rate, row.sample_errors) == (0, 0, 0.0, [])


def test_success_rate_gate():
    assert ProcessingStats(0, 0, 0).success_rate == 0.0
    assert ProcessingStats(4, 3, 1).success_rate == 75.0
    assert ProcessingStats(4, 2, 2).require().total == 4
    with pytest.raises(SuccessRateTooLow):
        ProcessingStats(4, 1, 3).require()
    with pytest.raises(SuccessRateTooLow):
        ProcessingStats(0, 0, 0).require()


def test_validate_lake(people):
    df = people({}, {"name": ""}, {"name": "  "}, {"age": 150}, {"status": None})
    row = validate_lake(df).first()
    assert row.asDict() == {"records_read": 3, "valid": 2, "invalid": 1, "dropped": 2, "blank_names": 1}
    by_rule = rejects_by_rule(check(df, processor.storage_spec())).collect()
    assert {r.rule: r.rejected for r in by_rule} == {"age": 1, "status": 1}


def test_a_parse_step_of_any_schema(spark):
    schema = T.StructType(
        [T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("d", T.DateType()), T.StructField("s", T.StringType())]
    )
    texts = [
        '{"n": 1, "x": "2.5", "d": "2024-02-29", "s": "a", "other": 1}', '{"n": "7.0"}', '{"n": 7.5}', '{"n": 99999999999}',
        '{"x": 1}', '{"n": null, "x": "?"}', '{"n": 1, "d": "2024-02-30"}', "{", "[]", "", None, '{"n": 1} x', '{"n": -5, "s": {"k": 1}}',
    ]
    lines = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "i int, value string, s string")
    spec = RecordSpec(
        tuple(schema.names), {"sign": F.when(F.col("n") < 0, F.lit("Negative"))}, {"n": F.col("n") + 1},
        processor.json_parser(schema, required_fields=("n",)),
    )
    rows = process(lines, spec).orderBy("i").collect()
    assert [(r.n, r.error_rule) for r in rows] == [
        (2, None), (8, None), (None, "n"), (None, "n"), (None, "n"), (None, "n"), (1, "d"),
        (None, "json"), (None, "json"), (None, "json"), (None, "json"), (None, "json"), (-5, "sign"),
    ]
    assert rows[0].x == 2.5 and str(rows[0].d) == "2024-02-29" and rows[0].s == "a"
    assert rows[3].error == "Parse error: Invalid n: 99999999999" and rows[4].error == "Parse error: Missing n"
    assert rows[6].error == "Parse error: Invalid d: 2024-02-30" and rows[12].s == '{"k":1}'
    assert process(lines.limit(0), spec).collect() == []
