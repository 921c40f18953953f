"""Profiles from stored sketches against exact ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterline.operators import profile, sketches

COLUMNS = ["pickup_datetime", "payment_type", "fare_amount", "tip_amount", "never"]
EXACT = ["column_name", "row_count", "null_count", "min_value", "max_value"]


def _trips(spark, n=40_000):
    k = F.col("id")
    day = F.date_add(F.lit("2024-01-20").cast("date"), (k % 40).cast("int"))
    return spark.range(n).select(
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"), k,
        (day.cast("timestamp") + F.make_dt_interval(secs=k % 86_400)).alias("pickup_datetime"),
        F.when(k % 7 > 0, (k % 6).cast("int")).alias("payment_type"),
        F.when(k % 11 > 0, F.pmod(k * 7919, F.lit(30_011)) / 100).alias("fare_amount"),
        F.when(k % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("tip_amount"),
        F.lit(None).cast("double").alias("never"),
    )


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('sketches')}/cells"
    trips = _trips(spark)
    sketches.store(trips.where("id % 3 = 0").withColumn("fare_amount", F.lit(-5.0)), COLUMNS, path, "b1")
    sketches.store(trips.where("id % 3 > 0"), COLUMNS, path, "b2")  # late rows of the same days
    sketches.store(trips.where("id % 3 = 0"), COLUMNS, path, "b1")  # replaces the first
    return path


@pytest.mark.parametrize("first, last", [("2024-01-25", "2024-02-10"), ("2023-01-01", "2025-01-01"), ("2024-02-03", "2024-02-03")])
def test_stored_profile_of_a_range(spark, stored, first, last):
    day = F.make_date("year", "month", "day")
    rows = _trips(spark).where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))).cache()
    found = {r.column_name: r for r in sketches.stored_profile(spark, stored, COLUMNS, first, last).collect()}
    for want in profile.column_profile(rows, COLUMNS).collect():
        got = found[want.column_name]
        text = [str(getattr(got, n)).replace("-0.0", "0.0") for n in EXACT]
        assert text == [str(getattr(want, n)).replace("-0.0", "0.0") for n in EXACT]
        assert abs(got.distinct_estimate - want.distinct_count) <= 0.07 * want.distinct_count
    fare = found["fare_amount"]
    n = rows.where("fare_amount IS NOT NULL").count()
    for label, rank in sketches.QUANTILES.items():
        below = rows.where(F.col("fare_amount") <= getattr(fare, label)).count()
        assert abs(below / n - rank) < 0.04
    assert found["never"].median is None and found["pickup_datetime"].median is None
    rows.unpersist()


def test_no_cells_in_the_range(spark, stored):
    found = sketches.stored_profile(spark, stored, COLUMNS, "2030-01-01", "2030-02-01").collect()
    assert {(r.row_count, r.null_count, r.min_value, r.distinct_estimate, r.median) for r in found} == {(0, 0, None, 0, None)}


def test_other_months_are_not_read(spark, stored):
    frame = sketches.stored_profile(spark, stored, COLUMNS, "2024-02-03", "2024-02-09")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
