from __future__ import annotations

import json
import os
import time

import pytest

from meterline import jobs
from meterline.plans import curated, incremental, publish, refresh
from meterline.sources import journal, layers, lease
from meterline.sources.layers import Lake
from meterline.streaming import ledger
from tests.test_sources import write
from tests.trip_rows import HEADER, LINE

FEBRUARY = LINE.replace("2024-01-15", "2024-02-20")
MARCH = LINE.replace("2024-01-15", "2024-03-10")


@pytest.fixture
def lake(tmp_path):
    os.makedirs(tmp_path / "raw")
    return Lake(f"{tmp_path}/lake", raw=f"{tmp_path}/raw")


def months(spark, lake):
    daily = layers.read_curated(spark, lake, "daily_trip_statistics")
    return {row.month: row.total_trips for row in daily.collect()}


def statuses(spark, lake):
    return {os.path.basename(row.path): row.status for row in ledger.files(spark, lake).collect()}


def same_as_full(spark, lake):
    full = incremental.full_tables(spark, lake)
    for table in curated.TABLES:
        stored = layers.read_curated(spark, lake, table.name)
        assert sorted(map(str, stored.collect())) == sorted(map(str, full[table.name].select(stored.columns).collect()))


# --- lease


def test_a_second_writer_leaves_at_once(spark, lake):
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    with lease.held(spark, lake, "one") as held:
        assert held.number == 1
        assert lease.take(spark, lake, "two") is None
        assert incremental.update(spark, lake) is None
        assert refresh.refresh(spark, lake) == []
        assert jobs.run(spark, jobs.arguments(["clean", "--lake", lake.root])) == "another writer is active"
    assert layers.if_present(lambda: layers.read_processed(spark, lake.processed)) is None
    assert len(incremental.update(spark, lake)) == 1


def test_an_expired_lease_is_taken_and_its_holder_stops(spark, lake):
    stuck = lease.take(spark, lake, "stuck", seconds=0)
    taken = lease.take(spark, lake, "next")
    assert (stuck.number, taken.number) == (1, 2)
    taken.check(spark)
    with pytest.raises(lease.LeaseLost):
        stuck.check(spark)
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    with pytest.raises(lease.LeaseLost):
        ledger.ingest_changes(spark, lake, stuck)
    assert ledger.state(spark, lake).batches == ()  # what it wrote is not visible
    log = [(row.number, row.holder, row.released_at) for row in lease.log(spark, lake).orderBy("number").collect()]
    assert log == [(1, "stuck", None), (2, "next", None)]


def test_a_lease_is_renewed(spark, lake):
    held = lease.take(spark, lake, "one", seconds=0.2)
    time.sleep(0.15)
    held.renew(spark)
    assert held.number == 2
    held.check(spark)


def test_a_record_without_its_line_is_passed_over_later(spark, lake):
    folder = f"{lake.root}/records"
    assert journal.append(spark, folder, {"x": 1}, 0) == 1
    torn = write(f"{folder}/000000002.json")
    os.truncate(torn, 0)
    assert journal.latest(spark, folder) == {"number": 1, "x": 1}
    assert journal.append(spark, folder, {"x": 2}, 1) is None  # perhaps it is being written
    os.utime(torn, (time.time() - 3600,) * 2)
    assert journal.append(spark, folder, {"x": 2}, 1) == 3
    assert journal.latest(spark, folder) == {"number": 3, "x": 2}


# --- ledger


def test_a_rewritten_file_replaces_its_rows(spark, lake):
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    write(f"{lake.raw}/b c%20[1].csv", HEADER, FEBRUARY)
    (first,) = incremental.update(spark, lake)
    assert months(spark, lake) == {1: 1, 2: 1}
    assert incremental.update(spark, lake) == []
    write(f"{lake.raw}/a.csv", HEADER, MARCH, MARCH)
    assert statuses(spark, lake) == {"a.csv": "changed", "b c%20[1].csv": "again"}
    (second,) = incremental.update(spark, lake)
    assert months(spark, lake) == {2: 1, 3: 2}
    assert set(statuses(spark, lake).values()) == {"read"}
    run = ledger.runs(spark, lake).orderBy("number").collect()
    assert [(r.reason, r.added, r.retired) for r in run] == [("ingest", [first], []), ("ingest", [second], [first])]
    same_as_full(spark, lake)


def test_rows_of_a_file_that_is_gone_stay(spark, lake):
    a = write(f"{lake.raw}/a.csv", HEADER, LINE)
    write(f"{lake.raw}/b.csv", HEADER, FEBRUARY)
    incremental.update(spark, lake)
    os.remove(a)
    write(f"{lake.raw}/b.csv", HEADER, MARCH, MARCH)
    write(f"{lake.raw}/new.csv", HEADER, LINE)
    assert statuses(spark, lake) == {"a.csv": "gone", "b.csv": "blocked", "new.csv": "new"}
    assert len(incremental.update(spark, lake)) == 1
    assert months(spark, lake) == {1: 2, 2: 1}


def test_files_are_dealt_to_batches(spark, lake):
    for name in "abcdefgh":
        write(f"{lake.raw}/{name}.csv", HEADER, LINE)
    batches = ledger.ingest_changes(spark, lake, max_files=3)
    assert 1 < len(batches) <= 3
    assert ledger.read_visible(spark, lake).count() == 8
    read = ledger.entries(spark, lake)
    assert read.count() == read.select("path").distinct().count() == 8


def test_a_crashed_run_shows_nothing(spark, lake, monkeypatch):
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    real = ledger.add_run
    monkeypatch.setattr(ledger, "add_run", lambda *_, **__: (_ for _ in ()).throw(OSError("lost before the record")))
    with pytest.raises(OSError):
        incremental.update(spark, lake)
    monkeypatch.setattr(ledger, "add_run", real)
    assert ledger.read_visible(spark, lake).count() == 0
    assert statuses(spark, lake) == {"a.csv": "new"}
    (batch,) = incremental.update(spark, lake)
    assert ledger.read_visible(spark, lake).count() == 1
    assert months(spark, lake) == {1: 1}
    (removed,) = ledger.remove_invisible(spark, lake)
    assert removed != batch
    assert ledger.read_visible(spark, lake).count() == 1
    assert layers.read_batches(spark, lake.processed).count() == 1


def test_no_files(spark, lake):
    assert incremental.update(spark, lake) == []
    assert incremental.publish_changes(spark, lake) is None
    assert layers.if_present(lambda: layers.read_curated(spark, lake, "daily_trip_statistics")) is None


# --- rewind


def test_rewind_is_as_if_later_runs_had_not_been(spark, lake):
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    incremental.update(spark, lake)
    write(f"{lake.raw}/b.csv", HEADER, LINE, FEBRUARY)
    write(f"{lake.raw}/a.csv", HEADER, MARCH)
    incremental.update(spark, lake)
    assert months(spark, lake) == {1: 1, 2: 1, 3: 1}
    assert len(incremental.rewind(spark, lake, 1)) == 1
    assert months(spark, lake) == {1: 1}
    same_as_full(spark, lake)
    assert statuses(spark, lake) == {"a.csv": "changed", "b.csv": "new"}
    incremental.update(spark, lake)
    assert months(spark, lake) == {1: 1, 2: 1, 3: 1}
    same_as_full(spark, lake)
    incremental.rewind(spark, lake, 0)
    assert months(spark, lake) == {}
    incremental.update(spark, lake)
    assert months(spark, lake) == {1: 1, 2: 1, 3: 1}
    with pytest.raises(ValueError):
        ledger.rewind(spark, lake, 99)


def test_a_run_whose_batches_are_gone_is_refused(spark, lake):
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    incremental.update(spark, lake)
    for line in (FEBRUARY, MARCH, LINE):
        write(f"{lake.raw}/a.csv", HEADER, line, line)
        incremental.update(spark, lake)
    assert jobs.run(spark, jobs.arguments(["clean", "--lake", lake.root, "--keep", "1"])) == "removed: 3 batches, 3 versions"
    assert months(spark, lake) == {1: 2}
    with pytest.raises(ValueError):
        ledger.rewind(spark, lake, 1)


# --- publication


def test_a_reader_sees_one_whole_set(spark, lake, monkeypatch):
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    incremental.update(spark, lake)
    begun = layers.read_curated(spark, lake, "daily_trip_statistics")
    write(f"{lake.raw}/a.csv", HEADER, FEBRUARY, FEBRUARY)
    real, calls = layers.write_curated, []

    def crash(*given):
        calls.append(given)
        for table in curated.TABLES:  # during the rebuild
            assert {r.month for r in layers.read_curated(spark, lake, table.name).collect()} == {1}
        if len(calls) == 3:
            raise OSError("lost at the third table")
        real(*given)

    monkeypatch.setattr(layers, "write_curated", crash)
    with pytest.raises(OSError):
        incremental.update(spark, lake)
    monkeypatch.setattr(layers, "write_curated", real)
    assert months(spark, lake) == {1: 1}
    assert len(publish.old_versions(spark, lake)) == 1  # of the failed run
    assert incremental.update(spark, lake) == []
    assert months(spark, lake) == {2: 2}
    assert [row.month for row in begun.collect()] == [1]
    assert len(publish.remove_old(spark, lake, keep=1)) == 2
    assert months(spark, lake) == {2: 2}
    same_as_full(spark, lake)


def test_unchanged_months_keep_their_version(spark, lake):
    write(f"{lake.raw}/a.csv", HEADER, LINE, FEBRUARY)
    incremental.update(spark, lake)
    before = layers.published_months(spark, lake)
    write(f"{lake.raw}/late.csv", HEADER, FEBRUARY)
    incremental.update(spark, lake)
    after = layers.published_months(spark, lake)
    assert after["2024-01"] == before["2024-01"] and after["2024-02"] != before["2024-02"]
    same_as_full(spark, lake)
    plan = layers.read_curated(spark, lake, "daily_trip_statistics")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_of_two_publications_one_is_lost(spark, lake, monkeypatch):
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    ledger.ingest_changes(spark, lake)
    real = layers.write_curated

    def slow(*given):
        real(*given)
        folder = f"{lake.published}"
        if not journal.numbers(spark, folder):
            journal.append(spark, folder, {"months": {}, "batches": []}, 0)

    monkeypatch.setattr(layers, "write_curated", slow)
    with pytest.raises(publish.PublicationLost):
        incremental.publish_changes(spark, lake)
    assert json.loads(open(f"{lake.published}/000000001.json").read())["months"] == {}
