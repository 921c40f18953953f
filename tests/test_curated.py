from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from meterline.functions import exact, labels
from meterline.plans import curated
from tests.trip_rows import processed


def summed(spark, values):
    frame = spark.createDataFrame([(value,) for value in values], "v DOUBLE")
    parts = frame.repartition(3).agg(*exact.sums("v", F.col("v")))
    return parts.select(exact.total("v").alias("total"), exact.mean("v").alias("mean")).first()


@pytest.mark.parametrize(
    ("values", "total", "mean"),
    [
        ([0.1, 0.2, 0.3], 0.6, 0.2),
        ([1.0, 1.01], 2.01, 1.01),  # the mean is a half: away from zero
        ([-1.0, -1.01], -2.01, -1.01),
        ([5.0, None], 5.0, 5.0),
        ([None, None], None, None),
        ([1e6 + 0.25] * 4, 4000001.0, 1000000.25),
        ([2e7, 1.5], 20000001.5, 10000000.75),  # too large for the BIGINT parts
        ([1e300, 1.0], 1e300, 5e299),
        ([math.inf, 1.0], math.inf, math.inf),
    ],
)
def test_exact_sums(spark, values, total, mean):
    row = summed(spark, values)
    assert (row.total, row.mean) == (total, mean)


def test_nan_is_not_lost(spark):
    row = summed(spark, [math.nan, 1.0])
    assert math.isnan(row.total) and math.isnan(row.mean)


def test_exact_sums_agree_with_decimals(spark):
    rng = random.Random(7)
    cents = [rng.randrange(-50_000, 50_000) for _ in range(4001)]
    row = summed(spark, [value / 100 for value in cents])
    mean = (Decimal(sum(cents)) / 100 / len(cents)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert row.total == sum(cents) / 100
    assert row.mean == float(mean)


@pytest.mark.parametrize(
    ("label", "cases"),
    [
        (
            labels.distance_bucket,
            {0.99: "0-1 miles", 1: "1-3 miles", 3: "3-5 miles", 5: "5-10 miles"}
            | {9.99: "5-10 miles", 10: "10-20 miles", 20: "20+ miles"},
        ),
        (
            labels.trip_category,
            {1.99: "Short (< 2 mi)", 2: "Medium (2-5 mi)", 5: "Long (5-10 mi)"}
            | {10: "Very Long (10+ mi)"},
        ),
        (labels.payment_method, {0: "Unknown", 1: "Credit Card", 2: "Cash", 3: "No Charge"}),
        (labels.payment_method, {4: "Dispute", 5: "Unknown", None: "Unknown"}),
        (labels.day_name, {1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday"}),
        (labels.day_name, {5: "Thursday", 6: "Friday", 7: "Saturday"}),
        (labels.day_type, {1: "Weekend", 2: "Weekday", 6: "Weekday", 7: "Weekend"}),
    ],
)
def test_labels(spark, label, cases):
    kind = "INT" if label not in (labels.distance_bucket, labels.trip_category) else "DOUBLE"
    values = [(float(case) if kind == "DOUBLE" else case,) for case in cases]
    rows = spark.createDataFrame(values, f"v {kind}").select("v", label(F.col("v")).alias("l"))
    assert {row.v: row.l for row in rows.collect()} == cases


@pytest.fixture(scope="module")
def many_trips(spark):
    """Two months, all hours, with a NULL payment type, a NULL tip, and one day with most rows."""
    rng, changes = random.Random(11), []
    for number in range(400):
        day = 3 if number % 3 else rng.randrange(1, 28)
        start = f"2024-{1 + number % 2:02d}-{day:02d} {rng.randrange(24):02d}:{number % 60:02d}"
        changes.append(
            {
                "tpep_pickup_datetime": f"{start}:00",
                "tpep_dropoff_datetime": f"{start}:{1 + number % 59:02d}",
                "passenger_count": str(1 + number % 8),
                "trip_distance": str(rng.randrange(1, 9999) / 100),
                "fare_amount": str(rng.randrange(1, 49999) / 100),
                "tip_amount": None if number % 17 == 0 else str(rng.randrange(0, 999) / 100),
                "total_amount": str(rng.randrange(1, 99999) / 100),
                "payment_type": None if number % 13 == 0 else str(number % 7),
            }
        )
    return processed(spark, *changes).cache()


@pytest.mark.parametrize("table", curated.TABLES, ids=lambda table: table.name)
def test_cells_give_the_same_table(spark, many_trips, table):
    direct = curated.from_trips(table, many_trips).collect()
    via_cells = curated.from_cells(table, curated.cells(many_trips)).collect()
    assert sorted(map(str, direct)) == sorted(map(str, via_cells))


@pytest.mark.parametrize("table", curated.TABLES, ids=lambda table: table.name)
def test_counts_add_up_to_the_trips(many_trips, table):
    count = next(name for name, output in table.outputs.items() if output.kind == "count")
    total = curated.from_trips(table, many_trips).agg(F.sum(count)).first()[0]
    assert total == many_trips.count() == 400


@pytest.mark.parametrize("table", curated.TABLES, ids=lambda table: table.name)
def test_close_to_plain_rounded_averages(many_trips, table):
    """Against the usual round(avg(x), 2): never further than the last place."""
    source = {
        "distance": "trip_distance",
        "fare": "fare_amount",
        "tip": "tip_amount",
        "total": "total_amount",
        "passengers": "passenger_count",
        "tip_share": "tip_percentage",
        "seconds": "trip_duration_minutes",
    }
    kinds = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min}
    dated = curated._with_dimensions(many_trips)
    plain = dated.groupBy(*table.keys).agg(
        *[
            F.round(kinds[output.kind](source[output.measure]), 2).alias(f"plain_{name}")
            for name, output in table.outputs.items()
            if output.kind != "count"
        ]
    )
    built = curated.from_trips(table, many_trips)
    same_key = [built[key].eqNullSafe(plain[key]) for key in table.keys]
    rows = built.join(plain, same_key).collect()
    assert len(rows) == built.count()
    for row in rows:
        for name, output in table.outputs.items():
            if output.kind != "count":
                ours, theirs = row[name], row[f"plain_{name}"]
                assert ours == theirs or abs(ours - theirs) < 0.0101, (name, row)


def test_null_payment_type_is_a_group(many_trips):
    rows = curated.from_trips(curated.PAYMENT, many_trips).filter("payment_type IS NULL").collect()
    assert len(rows) == 2 and {row.payment_method for row in rows} == {"Unknown"}
