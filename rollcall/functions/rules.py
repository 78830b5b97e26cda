"""Validation rules.  Each returns an error text, or null when the value is good."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.clock import instant_text, parse_instant
from rollcall.functions.text import capitalize_first, full_match, jvm_trim, utf16_length
from rollcall.schemas import ACTIVE, INACTIVE, MAX_AGE, MAX_CITY_LENGTH, MIN_AGE, PENDING, SUSPENDED

# Accepted formats.
EMAIL_PATTERN = r"[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
# A prefix, one separator, a reason without separators; trailing separators are dropped.
SUSPENDED_PATTERN = rf"{SUSPENDED}[^:]*:([^:]+):*"
# Five hex groups.  The JVM parser takes any group that fits a signed 64-bit number
# and keeps its low digits, within 36 characters in all.
UUID_PATTERN = "-".join([r"\+?0*[0-7]?[0-9A-Fa-f]{1,15}"] * 5)
UUID_LENGTH = 36
UUID_DIGITS = (8, 4, 4, 4, 12)
PLAIN_UUID = "-".join(f"[0-9a-f]{{{digits}}}" for digits in UUID_DIGITS)


def _rule(c: Column, field: str, bad: Column, message: Column) -> Column:
    return F.when(c.isNull(), F.lit(f"Missing {field}")).when(bad, message)


def required(c: Column, field: str) -> Column:
    return F.when(c.isNull(), F.lit(f"Missing {field}"))


def id_error(c: Column) -> Column:
    # The usual form is tested first; it needs no backtracking.
    lax = (F.length(c) <= UUID_LENGTH) & full_match(c, UUID_PATTERN)
    good = full_match(c, PLAIN_UUID) | lax
    return _rule(c, "id", ~good, F.concat(F.lit("Invalid UUID: "), c))


def email_error(c: Column) -> Column:
    return _rule(
        c, "email", ~full_match(c, EMAIL_PATTERN), F.concat(F.lit("Invalid email format: "), c)
    )


def age_error(c: Column) -> Column:
    """The upper bound is exclusive, whatever the message says."""
    message = F.format_string(f"Invalid age: %s (must be between {MIN_AGE} and {MAX_AGE})", c)
    return _rule(c, "age", (c < MIN_AGE) | (c >= MAX_AGE), message)


def city_error(c: Column) -> Column:
    city = jvm_trim(c)
    # No character takes more than two units, so short names need no second count.
    short = F.length(city).between(1, MAX_CITY_LENGTH // 2)
    good = short | utf16_length(city).between(1, MAX_CITY_LENGTH)
    return _rule(c, "city", ~good, F.concat(F.lit("Invalid city: '"), c, F.lit("'")))


def is_suspended(c: Column) -> Column:
    return full_match(c, SUSPENDED_PATTERN)


def status_error(c: Column) -> Column:
    return (
        F.when(c.isNull(), F.lit("Missing status"))
        .when(c.isin(ACTIVE, INACTIVE, PENDING) | is_suspended(c), F.lit(None).cast("string"))
        .when(c.startswith(SUSPENDED), F.concat(F.lit("Invalid suspended format: "), c))
        .otherwise(F.concat(F.lit("Unknown status: "), c))
    )


def created_at_error(c: Column) -> Column:
    return _rule(
        c, "createdAt", parse_instant(c).isNull(), F.concat(F.lit("Invalid timestamp: "), c)
    )


def name_error(name: Column, person_id: Column) -> Column:
    """Business rule: the name may not be blank."""
    return F.when(jvm_trim(name) == "", F.concat(F.lit("Empty name for person "), person_id))


def negative_age_error(age: Column, name: Column) -> Column:
    """Business rule kept for records that have not been through the age rule."""
    return F.when(age < 0, F.concat(F.lit("Negative age for "), name))


def first_error(*errors: Column) -> Column:
    return F.coalesce(*errors)


def record_errors() -> dict[str, Column]:
    """Rules of a storage row, in order.  The name is not checked here."""
    return {
        "id": id_error(F.col("id")),
        "email": email_error(F.col("email")),
        "age": age_error(F.col("age")),
        "city": city_error(F.col("city")),
        "status": status_error(F.col("status")),
        "createdAt": created_at_error(F.col("createdAt")),
    }


def business_errors() -> dict[str, Column]:
    return {
        "name": name_error(F.col("name"), F.col("id")),
        "negative_age": negative_age_error(F.col("age"), F.col("name")),
    }


# Canonical values of rows that passed the rules.


def canonical_id(c: Column) -> Column:
    groups = F.split(F.lower(F.replace(c, F.lit("+"), F.lit(""))), "-")
    padded = [
        F.substring(F.concat(F.lit("0" * width), F.get(groups, F.lit(i))), -width, width)
        for i, width in enumerate(UUID_DIGITS)
    ]
    return F.when(full_match(c, PLAIN_UUID), c).otherwise(F.concat_ws("-", *padded))


def suspend_reason(status: Column) -> Column:
    """Reason of a valid suspension, null for every other state."""
    return F.when(is_suspended(status), F.regexp_extract(status, rf"\A{SUSPENDED_PATTERN}\z", 1))


def storage_status(status: Column) -> Column:
    """`Suspended:<reason>` or the plain state name."""
    return F.coalesce(F.concat(F.lit(f"{SUSPENDED}:"), suspend_reason(status)), status)


def canonical_values() -> dict[str, Column]:
    return {
        "id": canonical_id(F.col("id")),
        "city": jvm_trim(F.col("city")),
        "status": storage_status(F.col("status")),
        "createdAt": instant_text(F.col("createdAt")),
    }


def normal_name(c: Column) -> Column:
    return jvm_trim(c)


def normal_city(c: Column) -> Column:
    return capitalize_first(F.lower(jvm_trim(c)))


def normal_values() -> dict[str, Column]:
    return {"name": normal_name(F.col("name")), "city": normal_city(F.col("city"))}
