"""Planned removal of expired days."""

from __future__ import annotations

import pytest

from meterline.operators import lifecycle
from meterline.plans import retention
from meterline.sources import layers, lease
from meterline.sources.layers import Lake
from meterline.sources.schemas import DAY_KEYS
from tests.trip_rows import processed

AS_OF = "2026-02-01"
OLD, EDGE, YOUNG = "2023-05-01", "2024-02-02", "2025-06-30"  # the second is exactly 730 days old


def _on(day):
    return {"tpep_pickup_datetime": f"{day} 08:00:00", "tpep_dropoff_datetime": f"{day} 08:30:00"}


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(f"{tmp_path}/lake", raw=f"{tmp_path}/raw")
    layers.append_processed(processed(spark, *[_on(d) for d in (OLD, "2023-05-02", EDGE, YOUNG, YOUNG)]), made.processed)
    return made


def _kept(spark, lake):
    trips = layers.read_processed(spark, lake.processed)
    return sorted(f"{r.year}-{r.month:02d}-{r.day:02d}" for r in trips.collect())


def _stored(frame):
    """Rows as they were when the plan was made."""
    return frame.sparkSession.createDataFrame(frame.collect(), frame.schema)


def test_plan_is_the_list_of_expired_days_and_removes_nothing(spark, lake):
    planned = retention.plan(spark, lake, AS_OF)
    days = lifecycle.partitions_of(layers.read_processed(spark, lake.processed))
    want = lifecycle.expired(days, AS_OF).where("layer = 'processed'").select(*DAY_KEYS, "age_days")
    assert sorted(planned.select(*DAY_KEYS, "age_days").collect()) == sorted(want.collect())
    assert {(r.files, r.bytes > 0) for r in planned.collect()} == {(1, True)}
    assert len(_kept(spark, lake)) == 5


def test_apply_removes_what_is_as_planned(spark, lake):
    planned = _stored(retention.plan(spark, lake, AS_OF))
    layers.append_processed(processed(spark, _on("2023-05-02")), lake.processed)  # late rows
    outcome = {r.day: r.outcome for r in retention.apply(spark, lake, planned, AS_OF).collect()}
    assert outcome == {1: "removed", 2: "changed"}
    assert _kept(spark, lake) == ["2023-05-02", "2023-05-02", EDGE, YOUNG, YOUNG]
    again = {r.day: r.outcome for r in retention.apply(spark, lake, planned, AS_OF).collect()}
    assert again == {1: "absent", 2: "changed"}


def test_days_within_their_retention_stay_whatever_the_plan_says(spark, lake):
    later = _stored(retention.plan(spark, lake, "2030-01-01"))
    assert later.count() == 4
    outcome = retention.apply(spark, lake, later, AS_OF).collect()
    assert sorted(r.outcome for r in outcome) == ["absent", "absent", "removed", "removed"]
    assert _kept(spark, lake) == [EDGE, YOUNG, YOUNG]


def test_an_active_writer_comes_first(spark, lake):
    planned = _stored(retention.plan(spark, lake, AS_OF))
    with lease.held(spark, lake) as mine:
        assert mine is not None
        assert retention.apply(spark, lake, planned, AS_OF) is None
    assert len(_kept(spark, lake)) == 5


def test_a_lake_without_trips(spark, tmp_path):
    empty = Lake(f"{tmp_path}/none", raw=f"{tmp_path}/raw")
    planned = retention.plan(spark, empty, AS_OF)
    assert planned.count() == 0
    assert retention.apply(spark, empty, planned, AS_OF).count() == 0
