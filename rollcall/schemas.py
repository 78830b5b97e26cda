"""Row types and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, states and bounds of the person record.
PERSON_FIELDS = ("id", "name", "email", "age", "city", "status", "createdAt")
EVENT_FIELDS = PERSON_FIELDS + ("eventTime",)
ACTIVE, INACTIVE, PENDING, SUSPENDED = "Active", "Inactive", "Pending", "Suspended"
MIN_AGE, MAX_AGE = 0, 150
MAX_CITY_LENGTH = 100
RUN_STATES = ("COMPLETED", "FAILED", "RUNNING", "PENDING")


def _struct(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


def _person_type(name: str) -> T.DataType:
    return T.IntegerType() if name == "age" else T.StringType()


PERSON_RECORD = _struct(*[(f, _person_type(f)) for f in PERSON_FIELDS])
PERSON_EVENT = _struct(*[(f, _person_type(f)) for f in PERSON_FIELDS], ("eventTime", T.LongType()))

# Partition values stay text: inference would read dt as DATE and hour=09 as 9.
PARTITION_KEYS = ("dt", "hour")
# The lake's last folder level: who wrote a batch, so that it replaces only itself.
LAKE_BATCH = "batch"
# The batch that first wrote a row, in folders that a compaction has made.
ORIGIN = "origin"
_PARTITIONS = [(k, T.StringType()) for k in PARTITION_KEYS]
LAKE = T.StructType(PERSON_EVENT.fields + _struct(*_PARTITIONS).fields)
LAKE_FOLDERS = _struct(*_PARTITIONS, (LAKE_BATCH, T.StringType()))
COMPACTION_LOG = T.StructType(
    _struct(("run", T.StringType()), ("state", T.StringType())).fields + LAKE_FOLDERS.fields
)
LEGACY_LAKE = T.StructType(PERSON_RECORD.fields + _struct(("dt", T.StringType())).fields)

# JSON is decoded with every field as text; numbers are then checked by rule, so
# one bad number rejects one row with a reason instead of nulling the record.
PERSON_TEXT = _struct(*[(f, T.StringType()) for f in PERSON_FIELDS])
EVENT_TEXT = _struct(*[(f, T.StringType()) for f in EVENT_FIELDS])

# Parts of city statistics: whole numbers that add up over batches.
CITY_PARTS = T.StructType(
    LAKE_FOLDERS.fields
    + _struct(
        ("city", T.StringType()),
        ("status", T.StringType()),
        *[(c, T.LongType()) for c in ("people", "ages", "age_sum")],
        ("age_squares", T.DecimalType(38, 0)),
        ("min_age", T.IntegerType()),
        ("max_age", T.IntegerType()),
    ).fields
)

# Readable records of a file as it stood when it was read.
FILE_RECORDS = _struct(
    ("path", T.StringType()),
    ("modificationTime", T.TimestampType()),
    ("length", T.LongType()),
    ("records", T.LongType()),
)

EVENT_LOG_FRAME = _struct(("key", T.StringType()), ("value", T.StringType()))

CITY_ROW = _struct(
    ("city", T.StringType()),
    ("total_people", T.LongType()),
    ("avg_age", T.DoubleType()),
    ("min_age", T.IntegerType()),
    ("max_age", T.IntegerType()),
)
AGE_GROUP_ROW = _struct(
    ("age_group", T.StringType()), ("count", T.LongType()), ("percentage", T.StringType())
)
REPORT = _struct(
    ("generated_at", T.StringType()),
    ("total_records", T.LongType()),
    ("city_statistics", T.ArrayType(CITY_ROW)),
    ("age_groups", T.ArrayType(AGE_GROUP_ROW)),
    ("status_distribution", T.MapType(T.StringType(), T.LongType())),
    ("email_domains", T.MapType(T.StringType(), T.LongType())),
)
# Text of a document that is no report.
UNREADABLE = "_unreadable"
REPORT_FIGURE = _struct(
    ("section", T.StringType()),
    ("key", T.StringType()),
    ("count", T.LongType()),
    ("avg_age", T.DoubleType()),
    ("min_age", T.IntegerType()),
    ("max_age", T.IntegerType()),
    ("percentage", T.StringType()),
)

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
RUN_LOG_JSON = _struct(
    ("taskId", T.StringType()),
    ("status", T.StringType()),
    ("startTime", T.StringType()),
    ("endTime", T.StringType()),
    ("duration", T.LongType()),
    ("recordsProcessed", T.LongType()),
    ("recordsFailed", T.LongType()),
    (
        "logs",
        T.ArrayType(
            _struct(
                ("timestamp", T.StringType()), ("message", T.StringType()), ("level", T.StringType())
            )
        ),
    ),
    ("taskData", _TEXT_MAP),
    ("sampleData", T.ArrayType(_TEXT_MAP)),
    ("error", T.StringType()),
)
