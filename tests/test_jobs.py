from __future__ import annotations

import pytest

from meterline import jobs
from meterline.sources import layers
from meterline.sources.layers import Lake
from tests.test_sources import write
from tests.trip_rows import HEADER, LINE


def job(spark, *given):
    return jobs.run(spark, jobs.arguments(given))


def test_jobs_of_a_lake(spark, tmp_path):
    root, raw = f"{tmp_path}/lake", f"{tmp_path}/raw"
    write(f"{raw}/a.csv", HEADER, LINE)
    assert job(spark, "refresh", "--lake", root, "--raw", raw) == "batches ingested: 1"
    write(f"{raw}/b.csv", HEADER, LINE)
    assert job(spark, "ingest", "--lake", root, "--raw", raw) == "batches ingested: 1"
    daily = lambda: layers.read_curated(spark, Lake(root, raw), "daily_trip_statistics").first().total_trips
    assert daily() == 1
    assert job(spark, "rebuild", "--lake", root) == "curated tables rebuilt"
    assert daily() == 2
    assert job(spark, "compact", "--lake", root, "--target", f"{tmp_path}/copy") == "rows copied: 2"
    for exact in ((), ("--exact",)):
        job(spark, "profile", "--lake", root, "--target", f"{tmp_path}/profile", *exact)
        rows = {r.column_name: r for r in spark.read.parquet(f"{tmp_path}/profile").collect()}
        assert (rows["fare_amount"].row_count, rows["fare_amount"].distinct_count) == (2, 1)


def test_no_trips(spark, tmp_path):
    assert job(spark, "rebuild", "--lake", f"{tmp_path}/lake") == "no trips, nothing written"


def test_arguments_are_required():
    with pytest.raises(SystemExit):
        jobs.arguments(["refresh", "--lake", "x"])
