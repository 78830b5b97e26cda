"""Compaction: rows stay the same at every step, and runs that died are finished or undone."""

import pytest
from pyspark.sql import functions as F

from rollcall.operators.events import to_events
from rollcall.sinks import compaction, storage
from rollcall.sinks.files import append_to_lake, settle_batch, write_lake
from rollcall.sources import files as source

DAY, HOUR = 1_704_067_200_000, 3_600_000


@pytest.fixture
def lake(spark, people, tmp_path):
    """Four batches over three hours."""
    path = str(tmp_path / "lake")
    for n in range(4):
        rows = people(*[{"city": f"c{n}-{i}"} for i in range(6)])
        write_lake(to_events(rows, F.lit(DAY) + F.substring("id", -1, 1).cast("int") % 3 * HOUR), path)
    return path


def rows(spark, lake):
    found = source.read_lake(spark, lake, batches=True).collect()
    scanned = source.scan_data_files(spark, lake)
    assert scanned.count() == len(found)
    return sorted(tuple(r) for r in found)


def folders(spark, lake):
    return len({f.path.rsplit("/", 1)[0] for f in source.list_data_files(spark, lake).collect()})


def step(spark, lake, monkeypatch, die):
    """A compaction that dies before it writes the rows' folders, or before it commits."""
    write = compaction._write_log

    def dying(spark, lake, run, log, state):
        if state == die:
            raise RuntimeError("gone")
        write(spark, lake, run, log, state)

    monkeypatch.setattr(compaction, "_write_log", dying)
    with pytest.raises(RuntimeError):
        source.compact_lake(spark, lake)
    monkeypatch.undo()


def test_packs_each_hour_and_keeps_rows_and_batch_names(spark, lake):
    before = rows(spark, lake)
    assert folders(spark, lake) == 12
    assert source.compact_lake(spark, lake) == 12
    assert rows(spark, lake) == before and folders(spark, lake) == 3
    assert source.compact_lake(spark, lake) == 0 and storage.folders(spark, compaction.log_path(lake)) == []


def test_readers_see_the_same_before_and_after_the_old_folders_go(spark, lake):
    before = rows(spark, lake)
    source.compact_lake(spark, lake, clean=False)
    assert rows(spark, lake) == before and folders(spark, lake) == 3
    assert compaction.recover(spark, lake) == 12
    assert rows(spark, lake) == before


@pytest.mark.parametrize("die", [compaction.ANNOUNCED, compaction.COMMITTED])
def test_a_run_that_dies_shows_nothing_and_is_undone(spark, lake, monkeypatch, die):
    before = rows(spark, lake)
    step(spark, lake, monkeypatch, die)
    assert rows(spark, lake) == before and folders(spark, lake) == 12
    compaction.recover(spark, lake)
    assert rows(spark, lake) == before
    assert source.compact_lake(spark, lake) == 12 and rows(spark, lake) == before


def test_bins_hold_about_the_target(spark):
    files = [("d", "00", f"b{n}", size) for n, size in enumerate([40, 40, 40, 40, 500, 10])] + [("d", "01", "b", 5)]
    listed = spark.createDataFrame(files + [(None, None, None, 7)], "dt string, hour string, batch string, length long")
    bins = {}
    for r in compaction.plan(listed, 100).collect():
        bins.setdefault((r.hour, r.bin), []).append(r.batch)
    assert sorted(map(sorted, bins.values())) == [["b0", "b1", "b2"], ["b3", "b5"]]


def test_late_batches_join_a_packed_hour(spark, lake, people):
    source.compact_lake(spark, lake)
    write_lake(to_events(people({"city": "late"}), F.lit(DAY)), lake)
    before = rows(spark, lake)
    assert source.compact_lake(spark, lake) == 2 and rows(spark, lake) == before


def test_a_batch_that_may_be_written_again_is_left_alone(spark, lake, people):
    late = to_events(people({"city": "again"}), F.lit(DAY))
    append_to_lake(late, lake, "q-7")
    before = rows(spark, lake)
    source.compact_lake(spark, lake)
    append_to_lake(late, lake, "q-7")
    assert rows(spark, lake) == before
    settle_batch(spark, lake, "q-7")
    assert source.compact_lake(spark, lake) == 2 and rows(spark, lake) == before


def test_a_named_write_replaces_itself(spark, people, tmp_path):
    path = str(tmp_path / "named")
    for city in ("first", "second"):
        write_lake(to_events(people({"city": city}), F.lit(DAY)), path, batch="job-1")
    assert [r.city for r in source.read_lake(spark, path).collect()] == ["second"]
