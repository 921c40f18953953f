"""Days found by the names of their folders."""

from __future__ import annotations

from datetime import date

import pytest

from meterline.plans import reports
from meterline.sources import layers, projection
from meterline.sources.layers import Lake
from meterline.streaming import ledger
from tests.test_sources import write
from tests.trip_rows import HEADER, LINE, processed

DAYS = ("2023-12-31", "2024-01-01", "2024-01-31", "2024-02-29", "2024-03-01", "2025-06-30")


def _on(day):
    return {"tpep_pickup_datetime": f"{day} 08:00:00", "tpep_dropoff_datetime": f"{day} 08:30:00"}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("projected")
    made = Lake(f"{root}/lake", raw=f"{root}/raw")
    layers.append_processed(processed(spark, *map(_on, DAYS)), made.processed)
    return made


def _days(frame):
    return sorted(f"{r.year}-{r.month:02d}-{r.day:02d}" for r in frame.collect())


@pytest.mark.parametrize(
    ("first", "last"),
    [("2024-01-01", "2024-02-29"), ("2023-12-31", "2024-01-01"), ("2020-01-01", "2030-12-31"), ("2024-02-02", "2024-02-28"), ("2024-01-31", "2024-03-01")],
)
def test_rows_are_those_of_discovery(spark, lake, first, last):
    found = projection.read_days(spark, lake, first, last)
    whole = layers.read_processed(spark, lake.processed)
    want = whole.where(f"make_date(year, month, day) BETWEEN DATE '{first}' AND DATE '{last}'")
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert found.schema == whole.schema


def test_folders_cover_each_day_once():
    names = projection.folders(date(2023, 12, 30), date(2024, 3, 2))
    assert names == [
        "year=2023/month=12/day=30", "year=2023/month=12/day=31", "year=2024/month=1", "year=2024/month=2",
        "year=2024/month=3/day=1", "year=2024/month=3/day=2",
    ]
    assert projection.folders(date(2024, 2, 1), date(2024, 2, 28))[-1] == "year=2024/month=2/day=28"
    assert projection.folders(date(2024, 1, 2), date(2024, 1, 1)) == []
    assert projection.folders(date(9999, 12, 31), date.max) == ["year=9999/month=12/day=31"]
    assert len(projection.folders(date(2000, 1, 2), date(2029, 12, 30))) == 418


def test_a_report_of_one_day_lists_one_folder(spark, lake):
    frame = reports.count_trips(projection.read_days(spark, lake, "2024-01-31", "2024-01-31"), 2024, 1, 31)
    assert frame.first()[0] == 1
    frame = projection.read_days(spark, lake, "2024-01-31", "2024-01-31")
    (relation,) = [node for node in _nodes(frame._jdf.queryExecution().optimizedPlan()) if hasattr(node, "relation")]
    roots = relation.relation().location().rootPaths()
    assert [str(roots.apply(i)).rpartition("/taxi_trips/")[2] for i in range(roots.size())] == ["year=2024/month=1/day=31"]


def _nodes(plan):
    if plan.nodeName().startswith("LogicalRelation"):
        yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def test_no_days(spark, lake, tmp_path):
    assert projection.read_days(spark, lake, "2024-01-02", "2024-01-01").count() == 0
    assert projection.read_days(spark, lake, "2019-01-01", "2019-01-01").count() == 0
    empty = projection.read_days(spark, Lake(f"{tmp_path}/none", raw=""), "2024-01-01", "2024-12-31")
    assert empty.count() == 0 and empty.columns == layers.read_processed(spark, lake.processed).columns


def test_only_visible_batches(spark, tmp_path):
    made = Lake(f"{tmp_path}/lake", raw=f"{tmp_path}/raw")
    write(f"{made.raw}/a.csv", HEADER, LINE)
    ledger.ingest_changes(spark, made)
    write(f"{made.raw}/a.csv", HEADER, LINE, LINE)
    ledger.ingest_changes(spark, made)
    assert projection.read_days(spark, made, "2024-01-01", "2024-01-31").count() == 2
    ledger.rewind(spark, made, 0)
    assert projection.read_days(spark, made, "2024-01-01", "2024-01-31").count() == 0


def test_a_view_needs_no_table(spark, lake):
    projection.days_view(spark, lake, "some_days", "2024-01-01", "2024-02-29")
    rows = spark.sql("SELECT CAST(pickup_day AS STRING) AS d, COUNT(*) AS n FROM some_days GROUP BY 1 ORDER BY 1").collect()
    assert [tuple(row) for row in rows] == [("2024-01-01", 1), ("2024-01-31", 1), ("2024-02-29", 1)]
    spark.catalog.dropTempView("some_days")
