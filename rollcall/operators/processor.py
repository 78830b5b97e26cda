"""Record processing driven by a spec: ordered rules, then value transforms.

A spec is plain Columns, so the runner works for any table and Catalyst sees
the whole chain as one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.rules import (
    age_error,
    business_errors,
    canonical_values,
    city_error,
    created_at_error,
    email_error,
    first_error,
    id_error,
    record_errors,
    required,
    status_error,
)
from rollcall.functions.codec import MALFORMED, decode_column
from rollcall.functions.clock import instant_text
from rollcall.functions.text import jvm_trim, whole_number
from rollcall.schemas import PENDING, PERSON_FIELDS, PERSON_TEXT

ERROR, RULE = "error", "error_rule"


@dataclass(frozen=True)
class RecordSpec:
    """Ordered rules (name -> error text or null), transforms (field -> new value), and a parse step.

    The parse step turns the frame that `process` is given into one with the spec's columns, and may
    leave `error` and `error_rule` for rows that cannot be read.
    """

    fields: tuple[str, ...]
    rules: Mapping[str, Column]
    transforms: Mapping[str, Column] = field(default_factory=dict)
    parse: Callable[[DataFrame], DataFrame] | None = None


def check(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """Add `error` and `error_rule`, both from the first rule that fails.

    Errors of an earlier check stay.  Rules are columns of their own first, so
    each is computed once per row.
    """
    names = {f"_rule_{name}": name for name in spec.rules}
    ruled = df.withColumns({f"_rule_{name}": error for name, error in spec.rules.items()})
    errors = [F.col(c) for c in names]
    failed = [F.when(F.col(c).isNotNull(), F.lit(name)) for c, name in names.items()]
    if ERROR in df.columns:
        errors, failed = [F.col(ERROR), *errors], [F.col(RULE), *failed]
    checked = ruled.withColumns({ERROR: first_error(*errors), RULE: F.coalesce(*failed)})
    return checked.drop(*names)


def accepted(checked: DataFrame, spec: RecordSpec) -> DataFrame:
    """Rows without error, transformed, error columns gone."""
    good = checked.filter(F.col(ERROR).isNull()).drop(ERROR, RULE)
    return good.withColumns(dict(spec.transforms)) if spec.transforms else good


def rejected(checked: DataFrame) -> DataFrame:
    """Rows with an error, as they came in."""
    return checked.filter(F.col(ERROR).isNotNull())


def process(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """Parse, check and transform in one projection: good rows get new values, bad rows keep theirs."""
    checked = check(spec.parse(df) if spec.parse else df, spec)
    good = F.col(ERROR).isNull()
    return checked.withColumns(
        {name: F.when(good, value).otherwise(F.col(name)) for name, value in spec.transforms.items()}
    )


def storage_spec() -> RecordSpec:
    """Storage rows back into valid people, with canonical values."""
    return RecordSpec(PERSON_FIELDS, record_errors(), canonical_values())


def business_spec() -> RecordSpec:
    return RecordSpec(PERSON_FIELDS, business_errors())


def _typed(text: Column, kind: T.DataType) -> Column:
    """Text of a JSON value as another type; null where it does not fit."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.IntegralType):
        return whole_number(text).try_cast(kind)
    return text.try_cast(kind)


def json_parser(
    schema: T.StructType, value: str = "value", required_fields: Collection[str] = ()
) -> Callable[[DataFrame], DataFrame]:
    """A parse step for JSON text of records with any flat schema.

    Adds the schema's columns and the first error in field order: text that is no object, a
    required field that is missing or null, or a value that does not fit its type, which is shown
    in the message.  A field of another name is passed over.  Columns of the frame stay, but for
    those that the schema names.
    """
    texts = T.StructType([T.StructField(f"_text_{f.name}", T.StringType()) for f in schema])
    as_named = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])

    def error(f: T.StructField) -> Column:
        text = F.col(f"_text_{f.name}")
        unfit = F.when(text.isNotNull() & F.col(f.name).isNull(), F.concat(F.lit(f"Invalid {f.name}: "), text))
        return F.coalesce(unfit, required(text, f.name)) if f.name in required_fields else unfit

    def parse(lines: DataFrame) -> DataFrame:
        passed = [c for c in lines.columns if c not in schema.names]
        decoded = decode_column(lines, value, as_named, passed)
        decoded = decoded.withColumnsRenamed({f.name: t.name for f, t in zip(schema, texts, strict=True)})
        typed = decoded.withColumns({f.name: _typed(F.col(f"_text_{f.name}"), f.dataType) for f in schema})
        rules = {"json": F.when(F.col(MALFORMED), F.lit("malformed JSON"))} | {f.name: error(f) for f in schema}
        messages = {name: F.concat(F.lit("Parse error: "), text) for name, text in rules.items()}
        checked = check(typed, RecordSpec(tuple(schema.names), messages))
        return checked.select(*passed, *schema.names, ERROR, RULE)

    return parse


def parse_people(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to person columns and `error`; canonical values where there is no error.

    Columns other than `value` are passed through.
    """
    passed = [c for c in lines.columns if c not in PERSON_FIELDS]
    decoded = decode_column(lines, value, PERSON_TEXT, passed)
    typed = decoded.withColumnRenamed("age", "_age_text").withColumn(
        "age", whole_number(F.col("_age_text")).try_cast("int")
    )
    good = F.col(ERROR).isNull()
    parsed = check(typed, RecordSpec(PERSON_FIELDS, _decode_errors()))
    canonical = {
        name: F.when(good, value).otherwise(F.col(name))
        for name, value in canonical_values().items()
    }
    return parsed.withColumns(canonical).select(*passed, *PERSON_FIELDS, ERROR, RULE)


def _decode_errors() -> dict[str, Column]:
    age_text = F.col("_age_text")
    errors = {
        "json": F.when(F.col(MALFORMED), F.lit("malformed JSON")),
        "id": id_error(F.col("id")),
        "name": required(F.col("name"), "name"),
        "email": email_error(F.col("email")),
        "age": F.coalesce(
            F.when(
                age_text.isNotNull() & F.col("age").isNull(),
                F.concat(F.lit("Invalid age: "), age_text),
            ),
            age_error(F.col("age")),
        ),
        "city": city_error(F.col("city")),
        "status": status_error(F.col("status")),
        "createdAt": created_at_error(F.col("createdAt")),
    }
    return {
        name: F.concat(F.lit("Parse error: "), message) for name, message in errors.items()
    }


def person_id_from(seed: Column) -> Column:
    """A version-4 shaped UUID from a hash, so reruns and retried tasks agree."""
    h = F.md5(seed.cast("binary"))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("4"), F.substring(h, 14, 3)),
        F.concat(F.lit("a"), F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def create_people(
    df: DataFrame, person_id: Column | None = None, created_at: Column | None = None
) -> DataFrame:
    """Build people from (name, email, age, city): new id, Pending, created now.

    The rules are e-mail, age, city; the name is trimmed but may be blank.
    """
    person_id = F.uuid() if person_id is None else person_id
    if created_at is None:
        created_at = F.concat(
            F.date_format(
                F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                "yyyy-MM-dd'T'HH:mm:ss.SSS",
            ),
            F.lit("Z"),
        )
    spec = RecordSpec(
        PERSON_FIELDS,
        {
            "email": email_error(F.col("email")),
            "age": age_error(F.col("age")),
            "city": city_error(F.col("city")),
        },
        {"name": jvm_trim(F.col("name")), "city": jvm_trim(F.col("city"))},
    )
    return process(df, spec).withColumns(
        {
            "id": person_id,
            "status": F.lit(PENDING),
            "createdAt": instant_text(created_at),
        }
    )
