"""Compaction in place of a lake kept by a ledger. Each test has a copy of one lake, with raw files that all share."""

from __future__ import annotations

import os
import shutil

import pytest

from meterline import jobs
from meterline.plans import incremental, publish
from meterline.sources import journal, layers, lease
from meterline.sources.layers import Lake
from meterline.streaming import ledger, merging
from tests.test_ledger import FEBRUARY, MARCH, months, same_as_full, statuses
from tests.test_sources import write
from tests.trip_rows import HEADER, LINE

BAD = LINE.replace("25.50", "-1.00")


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("merging")
    lake = Lake(f"{root}/lake", raw=f"{root}/raw")
    for files in ({"a": [LINE]}, {"b": [LINE, FEBRUARY, BAD], "c": [MARCH]}):
        for name, lines in files.items():
            write(f"{lake.raw}/{name}.csv", HEADER, *lines)
        ledger.ingest_changes(spark, lake)
    incremental.publish_changes(spark, lake)
    return lake


@pytest.fixture
def lake(made, tmp_path):
    return Lake(shutil.copytree(made.root, f"{tmp_path}/lake"), raw=made.raw)


def trips_of(spark, lake):
    return sorted(map(str, ledger.read_visible(spark, lake).collect()))


def _lost(*_, **__):
    raise OSError("lost")


def test_batches_become_one_with_the_same_rows(spark, lake):
    trips, version = trips_of(spark, lake), layers.published_months(spark, lake)
    (batch,) = merging.compact(spark, lake)
    assert ledger.state(spark, lake).batches == (batch,)
    assert trips_of(spark, lake) == trips and months(spark, lake) == {1: 2, 2: 1, 3: 1}
    assert statuses(spark, lake) == {"a.csv": "read", "b.csv": "read", "c.csv": "read"}
    audit = layers.read_batches(spark, lake.audit).where(f"ingest_batch = '{batch}'").first()
    assert (audit.files, audit.rows_read, audit.rows_kept, audit.rows_rejected, audit.months) == (3, 5, 4, 1, [202401, 202402, 202403])
    assert layers.read_batches(spark, lake.rejects).where(f"ingest_batch = '{batch}'").count() == 1
    # No month is written again for it, and the next run finds nothing to do.
    number = journal.latest(spark, lake.published)["number"]
    assert incremental.update(spark, lake) == [] and merging.compact(spark, lake) == []
    assert journal.latest(spark, lake.published)["number"] == number
    assert layers.published_months(spark, lake) == version
    ledger.remove_invisible(spark, lake, keep=1)
    january = f"{lake.processed}/year=2024/month=1/day=15"
    (kept,) = os.listdir(january)
    assert len([name for name in os.listdir(f"{january}/{kept}") if name.endswith(".parquet")]) == 1
    assert layers.read_processed(spark, lake.processed).count() == 4


def test_a_crash_shows_nothing_and_a_compaction_is_taken_back(spark, lake, monkeypatch):
    before, trips = ledger.state(spark, lake), trips_of(spark, lake)
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "add_run", _lost)
        with pytest.raises(OSError, match="lost"):
            merging.compact(spark, lake)
    assert ledger.state(spark, lake) == before and trips_of(spark, lake) == trips
    assert len(merging.compact(spark, lake)) == 1
    assert trips_of(spark, lake) == trips
    ledger.rewind(spark, lake, before.run)
    assert set(ledger.state(spark, lake).batches) == set(before.batches)
    assert trips_of(spark, lake) == trips


def test_a_crash_before_the_publication_costs_a_rebuild_only(spark, lake, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(publish, "renamed", _lost)
        with pytest.raises(OSError, match="lost"):
            merging.compact(spark, lake)
    assert months(spark, lake) == {1: 2, 2: 1, 3: 1}
    incremental.update(spark, lake)
    assert months(spark, lake) == {1: 2, 2: 1, 3: 1}
    same_as_full(spark, lake)


def test_groups_are_bounded(spark, lake, tmp_path):
    assert merging.groups(spark, lake, max_files=2, max_bytes=1 << 30) == []
    assert [len(group) for group in merging.groups(spark, lake, max_files=3, max_bytes=1 << 30)] == [2]
    assert merging.groups(spark, lake, max_files=9, max_bytes=1) == []
    with lease.held(spark, lake):
        assert jobs.run(spark, jobs.arguments(["merge", "--lake", lake.root])) == "another writer is active"
    assert merging.compact(spark, Lake(f"{tmp_path}/none", raw=lake.raw)) == []


def test_a_rewritten_file_of_a_merged_batch(spark, made):
    write(f"{made.raw}/d.csv", HEADER, FEBRUARY)
    ledger.ingest_changes(spark, made)  # a run that stopped before its publication
    merging.compact(spark, made)
    assert months(spark, made) == {1: 2, 2: 1, 3: 1}
    write(f"{made.raw}/a.csv", HEADER, MARCH)
    assert statuses(spark, made) == {"a.csv": "changed", "b.csv": "again", "c.csv": "again", "d.csv": "again"}
    incremental.update(spark, made)
    assert months(spark, made) == {1: 1, 2: 2, 3: 2}
    same_as_full(spark, made)
