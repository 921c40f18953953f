from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import StreamingQueryException

from meterline.operators import compaction
from meterline.plans import refresh
from meterline.sources import layers
from meterline.sources.layers import INGEST_BATCH, Lake
from meterline.streaming import ingest
from tests.test_sources import write
from tests.trip_rows import HEADER, LINE, processed

BAD_LINE = LINE.replace("2024-01-15 10:30:00", "junk").replace(",2,", ",9,")
FEBRUARY = LINE.replace("2024-01-15", "2024-02-20")


@pytest.fixture
def lake(tmp_path):
    os.makedirs(tmp_path / "raw")
    return Lake(f"{tmp_path}/lake", raw=f"{tmp_path}/raw")


def kept(spark, lake):
    return layers.read_processed(spark, lake.processed).count()


def test_only_new_files_are_read(spark, lake):
    write(f"{lake.raw}/a.csv", HEADER, LINE, BAD_LINE)
    assert len(ingest.ingest_new_files(spark, lake)) == 1
    assert kept(spark, lake) == 1
    assert ingest.ingest_new_files(spark, lake) == []
    write(f"{lake.raw}/deep/er/B.CSV", HEADER, LINE, FEBRUARY)
    write(f"{lake.raw}/ignored.txt", HEADER, LINE)
    assert len(ingest.ingest_new_files(spark, lake)) == 1
    assert kept(spark, lake) == 3
    audit = layers.read_batches(spark, lake.audit).orderBy("finished_at").collect()
    assert [(row.files, row.rows_read, row.rows_kept, row.rows_rejected) for row in audit] == [
        (1, 2, 1, 1),
        (1, 2, 2, 0),
    ]


def test_rejects_keep_record_reasons_and_file(spark, lake):
    write(f"{lake.raw}/a.csv", HEADER, LINE, BAD_LINE)
    ingest.ingest_new_files(spark, lake)
    (row,) = layers.read_batches(spark, lake.rejects).collect()
    assert set(row.broken_rules) == {
        "dropoff_present",
        "passengers_up_to_8",
        "pickup_before_dropoff",
    }
    assert '"VendorID":"1"' in row.raw_record and '"tpep_dropoff_datetime":"junk"' in row.raw_record
    assert row.source_file.endswith("/raw/a.csv")


def test_no_files_at_all(spark, lake):
    assert ingest.ingest_new_files(spark, lake) == []
    assert layers.if_present(lambda: layers.read_processed(spark, lake.processed)) is None
    assert refresh.refresh(spark, lake) == []


def test_batches_are_bounded(spark, lake):
    for name in "abcde":
        write(f"{lake.raw}/{name}.csv", HEADER, LINE)
    assert len(ingest.ingest_new_files(spark, lake, max_files=2)) == 3
    assert kept(spark, lake) == 5


def test_a_file_with_an_old_time_is_still_new(spark, lake):
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    ingest.ingest_new_files(spark, lake)
    late = write(f"{lake.raw}/late.csv", HEADER, LINE)
    month_ago = time.time() - 30 * 86400
    os.utime(late, (month_ago, month_ago))
    ingest.ingest_new_files(spark, lake)
    assert kept(spark, lake) == 2


def test_crash_after_writing_duplicates_nothing(spark, lake, monkeypatch):
    write(f"{lake.raw}/a.csv", HEADER, LINE, FEBRUARY, BAD_LINE)
    real = ingest._write_audit

    def crash(*_):
        raise OSError("lost before the batch was committed")

    monkeypatch.setattr(ingest, "_write_audit", crash)
    with pytest.raises(StreamingQueryException):
        ingest.ingest_new_files(spark, lake)
    assert kept(spark, lake) == 2
    monkeypatch.setattr(ingest, "_write_audit", real)
    write(f"{lake.raw}/b.csv", HEADER, LINE)
    assert len(ingest.ingest_new_files(spark, lake)) == 2
    assert kept(spark, lake) == 3
    assert layers.read_batches(spark, lake.rejects).count() == 1
    assert layers.read_batches(spark, lake.processed).select(INGEST_BATCH).distinct().count() == 2


def test_reset_reads_all_again_without_duplicates(spark, lake):
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    ingest.ingest_new_files(spark, lake)
    again = Lake(f"{lake.root}-2", raw=lake.raw)
    ingest.ingest_new_files(spark, again)
    assert kept(spark, lake) == kept(spark, again) == 1


def test_refresh_rebuilds_curated_tables(spark, lake):
    write(f"{lake.raw}/a.csv", HEADER, LINE, FEBRUARY)
    refresh.refresh(spark, lake)
    for table in ("hourly_trip_patterns", "payment_type_analysis", "distance_distribution"):
        assert layers.read_curated(spark, lake, table).count() == 2
    write(f"{lake.raw}/b.csv", HEADER, LINE)
    batches = refresh.refresh(spark, lake, only_new_months=True)
    assert refresh.months_of_batches(spark, lake, batches) == [(2024, 1)]
    daily = layers.read_curated(spark, lake, "daily_trip_statistics").orderBy("month").collect()
    assert [(row.month, row.total_trips, row.total_revenue) for row in daily] == [
        (1, 2, 51.0),
        (2, 1, 25.5),
    ]
    assert not refresh.rebuild_curated(spark, lake, months=[])
    assert not refresh.rebuild_curated(spark, lake, months=[(1999, 1)])


@pytest.mark.parametrize("only_new_months", [False, True])
def test_a_refresh_makes_up_for_a_failed_rebuild(spark, lake, monkeypatch, only_new_months):
    write(f"{lake.raw}/a.csv", HEADER, LINE)
    refresh.refresh(spark, lake)
    write(f"{lake.raw}/b.csv", HEADER, FEBRUARY)
    real, calls = layers.write_curated, []

    def crash(*arguments):
        calls.append(arguments)
        if len(calls) == 3:
            raise OSError("lost between the writes")
        real(*arguments)

    monkeypatch.setattr(layers, "write_curated", crash)
    with pytest.raises(OSError):
        refresh.refresh(spark, lake, only_new_months)
    monkeypatch.setattr(layers, "write_curated", real)
    assert len(refresh.batches_to_rebuild(spark, lake)) == 1
    assert refresh.refresh(spark, lake, only_new_months) == []
    for table in ("hourly_trip_patterns", "payment_type_analysis", "distance_distribution"):
        assert layers.read_curated(spark, lake, table).count() == 2
    assert refresh.batches_to_rebuild(spark, lake) == []


def test_loads_ingest_and_compaction_share_a_layout(spark, lake, tmp_path):
    layers.append_processed(processed(spark), lake.processed)
    write(f"{lake.raw}/a.csv", HEADER, LINE, FEBRUARY)
    ingest.ingest_new_files(spark, lake)
    assert kept(spark, lake) == 3
    copy = Lake(f"{tmp_path}/second", raw=lake.raw)
    assert compaction.compact_trips(spark, lake.processed, copy.processed) == 3
    layers.append_processed(processed(spark), copy.processed)
    assert kept(spark, copy) == 4


def test_a_hot_day_is_split_over_tasks(spark, tmp_path):
    """A day with nearly all trips must be written by several tasks."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256k")
    try:
        seconds = "make_timestamp(2024, 1, IF(id % 50 = 0, 1 + id % 28, 15), 10, 0, 0)"
        trips = spark.range(0, 400_000, 1, 8).selectExpr(
            f"{seconds} + make_interval(0, 0, 0, 0, 0, 0, id % 3600) AS pickup_datetime",
            "rand(1) AS fare_amount",
            "2024 AS year",
            "1 AS month",
            "CAST(IF(id % 50 = 0, 1 + id % 28, 15) AS INT) AS day",
        )
        layers.append_processed(trips, f"{tmp_path}/p")
    finally:
        spark.conf.set(size, before)
    (load,) = os.listdir(f"{tmp_path}/p/year=2024/month=1/day=15")
    hot = os.listdir(f"{tmp_path}/p/year=2024/month=1/day=15/{load}")
    assert len([name for name in hot if name.endswith(".parquet")]) >= 4
    assert spark.read.parquet(f"{tmp_path}/p").count() == 400_000
