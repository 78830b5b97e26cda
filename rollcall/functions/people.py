"""Attributes of a person: bands, flags, e-mail parts, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.rules import suspend_reason
from rollcall.functions.text import piece
from rollcall.schemas import ACTIVE, PENDING

ADULT_AGE = 18

# Fixed values: (exclusive upper age, label), then the label of everyone else.
AGE_GROUPS = ((18, "Minor"), (30, "Young Adult"), (50, "Adult"), (65, "Middle Age"))
OLDEST_GROUP = "Senior"
AGE_CATEGORIES = ((13, "child"), (20, "teen"), (65, "adult"))
OLDEST_CATEGORY = "senior"
ANONYMOUS_EMAIL = "anonymous@example.com"


def _band(age: Column, bands: tuple[tuple[int, str], ...], rest: str) -> Column:
    (bound, label), *others = bands
    chain = F.when(age < bound, label)
    for bound, label in others:
        chain = chain.when(age < bound, label)
    return chain.otherwise(rest)


def age_group(age: Column) -> Column:
    """Reporting band; an unknown age falls into the last one."""
    return _band(age, AGE_GROUPS, OLDEST_GROUP)


def age_category(age: Column) -> Column:
    """Life stage; other bounds than `age_group`."""
    return _band(age, AGE_CATEGORIES, OLDEST_CATEGORY)


def is_adult(age: Column) -> Column:
    return age >= ADULT_AGE


def is_minor(age: Column) -> Column:
    return age < ADULT_AGE


def email_username(email: Column) -> Column:
    return piece(email, "@", 0)


def email_domain(email: Column) -> Column:
    """The part after the first `@`, null without one."""
    return piece(email, "@", 1)


def domain_or_unknown(email: Column) -> Column:
    """The last non-empty part; `unknown` when the text is made of `@` only."""
    parts = F.split(F.rtrim(email, F.lit("@")), "@")
    return F.when(email.rlike(r"\A@+\z"), F.lit("unknown")).otherwise(F.element_at(parts, -1))


def name_length(name: Column) -> Column:
    return F.length(name)


def is_active(status: Column) -> Column:
    return status == ACTIVE


def is_available(status: Column) -> Column:
    """Active or waiting; wider than `is_active`."""
    return status.isin(ACTIVE, PENDING)


def categorize(age: Column, status: Column) -> Column:
    return (
        F.when(is_minor(age), "Minor")
        .when(is_adult(age) & is_active(status), "Active Adult")
        .when(
            suspend_reason(status).isNotNull(), F.concat(F.lit("Suspended: "), suspend_reason(status))
        )
        .otherwise("Other")
    )


def anonymous_name(person_id: Column) -> Column:
    return F.concat(F.lit("User-"), F.substring(person_id, 1, 8))


def summary(name: Column, age: Column, city: Column, status: Column) -> Column:
    return F.concat(
        name, F.lit(" ("), age.cast("string"), F.lit("yo, "), city, F.lit(") - "), status
    )
