"""String helpers with JVM semantics, built from Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including the blank, as the JVM's trim treats them.
BLANKS = "".join(map(chr, range(0x21)))


def jvm_trim(c: Column) -> Column:
    """Trim control characters as well as blanks (Spark's own trim keeps tabs)."""
    return F.btrim(c, F.lit(BLANKS))


def full_match(c: Column, pattern: str) -> Column:
    """Whole-string match; `$` would accept a trailing newline."""
    return c.rlike(rf"\A(?:{pattern})\z")


def piece(c: Column, separator: str, index: int) -> Column:
    """The index-th part of a split, null when there are fewer parts."""
    return F.get(F.split(c, separator), F.lit(index))


def utf16_length(c: Column) -> Column:
    """Length in UTF-16 units, where a character outside the BMP counts twice."""
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")


def capitalize_first(c: Column) -> Column:
    """Upper-case the first character only; `initcap` would touch every word."""
    first = F.substring(c, 1, 1)
    upper = F.upper(first)
    # A character whose upper case is longer than itself stays as it is.
    return F.concat(F.when(F.length(upper) == 1, upper).otherwise(first), F.substr(c, F.lit(2)))


def whole_number(c: Column) -> Column:
    """Text of a JSON number with no fractional part, as bigint; null for anything else."""
    digits = F.regexp_extract(c, r"\A([+-]?\d{1,19})(?:\.0*)?\z", 1)
    return digits.try_cast("bigint")
