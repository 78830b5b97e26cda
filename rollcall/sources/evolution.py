"""Columns that a lake's files have come to carry, reconciled over all batches."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Types that hold every value of those before them.
WIDER = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()),
    (T.FloatType(), T.DoubleType()),
)


class SchemaClash(ValueError):
    """A column has types that no one type can hold; names the column, the types and a file of each."""

    def __init__(self, column: str, places: dict[T.DataType, str]):
        self.column, self.places = column, places
        told = ", ".join(f"{kind.simpleString()} in {path}" for kind, path in places.items())
        super().__init__(f"column {column} has no common type: {told}")


def stored_schemas(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, str]]:
    """Schemas that together have every column of the files, each with one of its files.

    Spark reads the footers in tasks.  Only where types do not fit are the files halved, so the
    number of jobs follows the number of changes, not of files.
    """
    paths = list(paths)
    try:
        return [(spark.read.option("mergeSchema", True).parquet(*paths).schema, paths[0])] if paths else []
    except (PySparkException, Py4JJavaError) as failure:
        if "CANNOT_MERGE" not in str(failure) or len(paths) == 1:
            raise
        half = len(paths) // 2
        return stored_schemas(spark, paths[:half]) + stored_schemas(spark, paths[half:])


def common_type(kinds: Sequence[T.DataType]) -> T.DataType | None:
    """The narrowest type that holds all of them."""
    if len(set(kinds)) == 1:
        return kinds[0]
    for family in WIDER:
        if all(kind in family for kind in kinds):
            return max(kinds, key=family.index)
    return None


def reconciled(schemas: Sequence[tuple[T.StructType, str]]) -> T.StructType:
    """One schema with every column, in order of appearance and as wide as needed."""
    places: dict[str, dict[T.DataType, str]] = {}
    for schema, path in schemas:
        for field in schema.fields:
            places.setdefault(field.name, {}).setdefault(field.dataType, path)
    fields = []
    for name, kinds in places.items():
        kind = common_type(list(kinds))
        if kind is None:
            raise SchemaClash(name, kinds)
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)
