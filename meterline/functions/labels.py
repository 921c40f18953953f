"""Names for codes and ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels that the tables and reports show.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
PAYMENT_METHODS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
OTHER_PAYMENT = "Unknown"
# Upper bounds in miles, not included in the range; the last range is open.
DISTANCE_BUCKETS = (
    (1, "0-1 miles"),
    (3, "1-3 miles"),
    (5, "3-5 miles"),
    (10, "5-10 miles"),
    (20, "10-20 miles"),
    (None, "20+ miles"),
)
TRIP_CATEGORIES = (
    (2, "Short (< 2 mi)"),
    (5, "Medium (2-5 mi)"),
    (10, "Long (5-10 mi)"),
    (None, "Very Long (10+ mi)"),
)
WEEKEND = (1, 7)


def _by_upper_bound(value: Column, ranges: tuple) -> Column:
    *bounded, (_, last) = ranges
    label = F.lit(last)
    for bound, name in reversed(bounded):
        label = F.when(value < bound, name).otherwise(label)
    return label


def distance_bucket(miles: Column) -> Column:
    return _by_upper_bound(miles, DISTANCE_BUCKETS)


def distance_bucket_rank(bucket: Column) -> Column:
    return F.array_position(F.array(*[F.lit(name) for _, name in DISTANCE_BUCKETS]), bucket)


def trip_category(miles: Column) -> Column:
    return _by_upper_bound(miles, TRIP_CATEGORIES)


def day_name(day_of_week: Column) -> Column:
    """1 is Sunday."""
    return F.element_at(F.array(*[F.lit(name) for name in WEEKDAYS]), day_of_week)


def day_type(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(*WEEKEND), "Weekend").otherwise("Weekday")


def payment_method(code: Column) -> Column:
    names = F.create_map(*[F.lit(item) for pair in PAYMENT_METHODS.items() for item in pair])
    return F.coalesce(names[code], F.lit(OTHER_PAYMENT))
