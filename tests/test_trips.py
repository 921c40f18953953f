from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from meterline.operators import quality, trips
from tests.trip_rows import processed, raw


def typed(spark, **change):
    return trips.typed_trips(raw(spark, change)).first()


def test_smoke_row(spark):
    row = trips.with_time_dimensions(processed(spark)).first()
    assert (row.trip_duration_minutes, row.avg_speed_mph, row.tip_percentage) == (30.0, 11.0, 19.61)
    assert (row.year, row.month, row.day) == (2024, 1, 15)
    assert (row.pickup_hour, row.pickup_day_of_week) == (10, 2)
    assert row.pickup_date == dt.date(2024, 1, 15)


@pytest.mark.parametrize(
    ("text", "value"),
    [("2", 2), (" 2 ", 2), ("2.0", 2), ("1.7", 1), ("-1.9", -1), ("3.", 3)]
    + [("n/a", None), ("2.x", None), ("2e0", None), ("", None), (None, None)]
    + [("99999999999", None), ("99999999999.0", None), ("NaN", None)],
)
def test_integer_text(spark, text, value):
    assert typed(spark, passenger_count=text).passenger_count == value


@pytest.mark.parametrize(
    ("text", "value"), [("1.5", 1.5), ("1e1", 10.0), (" 7 ", 7.0), ("x", None), (None, None)]
)
def test_number_text(spark, text, value):
    assert typed(spark, trip_distance=text).trip_distance == value


@pytest.mark.parametrize("text", ["junk", "2024-13-01 00:00:00", "", None])
def test_bad_timestamp_is_null(spark, text):
    assert typed(spark, tpep_pickup_datetime=text).pickup_datetime is None


BOUNDS = [
    ({"passenger_count": "0"}, {"passengers_above_0"}),
    ({"passenger_count": "1"}, set()),
    ({"passenger_count": "8"}, set()),
    ({"passenger_count": "9"}, {"passengers_up_to_8"}),
    ({"passenger_count": None}, {"passengers_above_0", "passengers_up_to_8"}),
    ({"trip_distance": "0"}, {"distance_above_0"}),
    ({"trip_distance": "0.01"}, set()),
    ({"trip_distance": "99.99"}, set()),
    ({"trip_distance": "100"}, {"distance_below_100"}),
    ({"trip_distance": None}, {"distance_above_0", "distance_below_100"}),
    ({"fare_amount": "0"}, {"fare_above_0"}),
    ({"fare_amount": "499.99"}, set()),
    ({"fare_amount": "500"}, {"fare_below_500"}),
    ({"fare_amount": None}, {"fare_above_0", "fare_below_500"}),
    ({"total_amount": "0"}, {"total_above_0"}),
    ({"total_amount": "-1"}, {"total_above_0"}),
    ({"total_amount": "0.01"}, set()),
    ({"total_amount": None}, {"total_above_0"}),
    ({"tpep_dropoff_datetime": "2024-01-15 10:00:00"}, {"pickup_before_dropoff"}),
    ({"tpep_dropoff_datetime": "2024-01-15 10:00:01"}, set()),
    ({"tpep_pickup_datetime": None}, {"pickup_present", "pickup_before_dropoff"}),
    ({"tpep_dropoff_datetime": "x"}, {"dropoff_present", "pickup_before_dropoff"}),
    ({"tip_amount": None}, set()),
    ({"tip_amount": "-3"}, set()),
    ({"payment_type": None}, set()),
]


def test_rule_bounds(spark):
    """One row per case, told apart by its place."""
    frame = raw(spark, *[change for change, _ in BOUNDS]).coalesce(1)
    numbered = trips.typed_trips(frame.withColumn("case", F.monotonically_increasing_id()), "case")
    broken = {row.case: set(row.broken_rules) for row in quality.rejected(numbered).collect()}
    kept = {row.case for row in quality.kept(numbered).collect()}
    for case, (_, expected) in enumerate(BOUNDS):
        assert broken.get(case, set()) == expected, BOUNDS[case]
        assert (case in kept) == (not expected)
    counts = {row.rule: row.rejected_rows for row in quality.reject_counts(numbered).collect()}
    assert counts == {r: sum(r in broken_here for _, broken_here in BOUNDS) for r in quality.RULES}
    stats = quality.statistics(numbered).first()
    assert stats.rows_read == len(BOUNDS) == stats.rows_kept + stats.rows_rejected


def test_tip_share_of_null_and_negative_tips(spark):
    rows = processed(spark, {"tip_amount": None}, {"tip_amount": "-2.55"}).collect()
    assert [row.tip_percentage for row in rows] == [None, -10.0]


def test_infinite_total_is_kept(spark):
    row = processed(spark, {"total_amount": "Infinity"}).first()
    assert math.isinf(row.total_amount)


def test_rules_test_the_listed_columns():
    named = " ".join(quality.RULES.values())
    assert all(column in named for column in quality.TESTED_COLUMNS)
    assert not any(
        column in named for column in trips.TYPED_COLUMNS if column not in quality.TESTED_COLUMNS
    )


def test_text_is_parsed_once(spark):
    """The filter must stay above the parsing, and tip and payment must be pruned when unused."""
    plan = processed(spark).select("year")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("tpep_pickup_datetime") <= 3
    assert "tip_amount#" not in plan.split("LogicalRDD")[0]
