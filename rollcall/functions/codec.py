"""JSON text of people and events."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "_malformed"


def to_json_text(fields: Iterable[str]) -> Column:
    """One JSON object; null fields are written, so a decoder can tell them apart."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_json_bytes(fields: Iterable[str]) -> Column:
    return to_json_text(fields).cast("binary")


def from_json_text(value: Column, schema: T.StructType) -> Column:
    """Decode text or UTF-8 bytes; unknown fields are ignored."""
    return F.from_json(value.cast("string"), schema)


def decode_column(df: DataFrame, value: str, schema: T.StructType, keep: list[str]) -> DataFrame:
    """The columns `keep`, the fields of the JSON object in `value`, and whether it is malformed.

    The text is read as the only element of an array, so text after the object makes
    it malformed instead of being passed over.  The record is unfolded by a generator:
    Catalyst moves later filters below a projection, where each would decode the text
    again, but leaves them above a generator, so every text is decoded once.
    """
    wrapped = F.concat(F.lit("["), F.col(value).cast("string"), F.lit("]"))
    elements = F.array(F.from_json(wrapped, T.ArrayType(schema)))
    single = F.flatten(F.filter(elements, lambda found: F.size(found) == 1))
    unfolded = df.select(*keep, F.posexplode_outer(single).alias("_at", "_record"))
    malformed = F.col("_at").isNull() | F.col("_record").isNull()
    return unfolded.select(*keep, "_record.*", malformed.alias(MALFORMED))
