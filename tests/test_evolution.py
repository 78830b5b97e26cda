"""Schemas found from files, and scans that list only the days asked for."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.events import to_events
from rollcall.sinks.files import write_lake
from rollcall.sources import files as source
from rollcall.sources.evolution import SchemaClash, common_type

DAY = 1_704_067_200_000


def write(spark, people, lake, day, **extra):
    rows = to_events(people({}, {"city": "Rome"}), F.lit(DAY + day * 86_400_000))
    write_lake(rows.withColumns({k: F.expr(v) for k, v in extra.items()}), lake)


def test_new_columns_are_found_and_widened(spark, people, tmp_path):
    lake = str(tmp_path / "lake")
    write(spark, people, lake, 0)
    write(spark, people, lake, 1, visits="7", country="'it'")
    write(spark, people, lake, 1, visits="5000000000L", rate="float(0.5)")
    assert source.added_columns(spark, lake).simpleString() == "struct<visits:bigint,country:string,rate:float>" or {
        f.name: f.dataType.simpleString() for f in source.added_columns(spark, lake).fields
    } == {"visits": "bigint", "country": "string", "rate": "float"}
    rows = source.read_lake(spark, lake, merge_schema=True).collect()
    assert sorted((r.visits or 0, r.country or "", r.rate or 0) for r in rows) == [(0, "", 0)] * 2 + [(7, "it", 0)] * 2 + [(5_000_000_000, "", 0.5)] * 2


def test_a_clash_names_column_types_and_files(spark, people, tmp_path):
    lake = str(tmp_path / "lake")
    write(spark, people, lake, 0, visits="7")
    write(spark, people, lake, 2, visits="'seven'")
    with pytest.raises(SchemaClash) as clash:
        source.read_lake(spark, lake, merge_schema=True)
    assert clash.value.column == "visits" and {k.simpleString() for k in clash.value.places} == {"int", "string"}
    assert len(source.read_lake(spark, lake).columns) == 10


def test_common_types():
    assert common_type([T.IntegerType(), T.LongType(), T.ByteType()]) == T.LongType()
    assert common_type([T.IntegerType(), T.DoubleType()]) == T.DoubleType()
    assert common_type([T.LongType(), T.DoubleType()]) is None and common_type([T.StringType(), T.DateType()]) is None


def test_bounds_list_only_their_days(spark, people, tmp_path):
    lake = str(tmp_path / "lake")
    for day in range(4):
        write(spark, people, lake, day)
        write(spark, people, f"{lake}/region=eu", day)
    people({}).write.parquet(f"{lake}/loose")
    found = source.scan_data_files(spark, lake, dt_from="2024-01-02", dt_to="2024-01-03")
    assert found.groupBy("dt").count().orderBy("dt").collect() == [("2024-01-02", 4), ("2024-01-03", 4)]
    assert all("/dt=2024-01-02/" in f or "/dt=2024-01-03/" in f for f in found.inputFiles())
    assert source.scan_data_files(spark, lake, dt_from="2024-01-04").count() == 4
    assert source.scan_data_files(spark, lake, dt_to="2023-01-01").count() == 0
    assert source.scan_data_files(spark, lake).count() == 17
