"""The rules a trip must meet, as data: one list drives keeping, rejecting and counting."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A rule that is NULL is broken, as a filter drops the row.
RULES: dict[str, str] = {
    "pickup_present": "pickup_datetime IS NOT NULL",
    "dropoff_present": "dropoff_datetime IS NOT NULL",
    "passengers_above_0": "passenger_count > 0",
    "passengers_up_to_8": "passenger_count <= 8",
    "distance_above_0": "trip_distance > 0",
    "distance_below_100": "trip_distance < 100",
    "fare_above_0": "fare_amount > 0",
    "fare_below_500": "fare_amount < 500",
    "total_above_0": "total_amount > 0",
    "pickup_before_dropoff": "pickup_datetime < dropoff_datetime",
}

TESTED_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
)


def _met(rule: str) -> Column:
    return F.coalesce(F.expr(RULES[rule]), F.lit(False))


def all_met() -> Column:
    return F.coalesce(reduce(and_, [F.expr(rule) for rule in RULES.values()]), F.lit(False))


def broken_rules() -> Column:
    names = [F.when(~_met(rule), F.lit(rule)) for rule in RULES]
    return F.array_compact(F.array(*names))


def kept(typed: DataFrame) -> DataFrame:
    return typed.filter(all_met())


def rejected(typed: DataFrame) -> DataFrame:
    """Trips that break a rule, each with every rule it breaks."""
    return typed.filter(~all_met()).withColumn("broken_rules", broken_rules())


def reject_counts(typed: DataFrame) -> DataFrame:
    """Rows that break each rule. One pass with ten counters; a row can count several times."""
    counters = typed.agg(*[F.count_if(~_met(rule)).alias(rule) for rule in RULES])
    return counters.unpivot([], list(RULES), "rule", "rejected_rows")


def statistics(typed: DataFrame) -> DataFrame:
    """Rows read, kept and rejected, as one row."""
    return typed.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(all_met()).alias("rows_kept"),
        F.count_if(~all_met()).alias("rows_rejected"),
    )
