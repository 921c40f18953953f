"""Reports over the processed and curated layers.

A month is picked by partition columns, so a report on stored tables reads only that month. Where a
report shows a limited number of rows, ties are broken by further keys and the result is the same
on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions import exact, labels

YEAR, MONTH = 2024, 1
GB_PER_RECORD = "0.00001"


def in_partition(
    table: DataFrame, year: int, month: int | None = None, day: int | None = None
) -> DataFrame:
    for name, value in (("year", year), ("month", month), ("day", day)):
        if value is not None:
            table = table.filter(F.col(name) == value)
    return table


# --- curated layer ---------------------------------------------------------------------------


def daily_revenue_trends(daily: DataFrame, year: int = YEAR, month: int = MONTH, days: int = 31):
    trips = F.col("total_trips")
    return (
        in_partition(daily, year, month)
        .orderBy(F.desc("pickup_date"))
        .limit(days)
        .select(
            "pickup_date",
            "total_trips",
            "total_revenue",
            "total_tips",
            exact.ratio(F.col("total_revenue"), trips).alias("revenue_per_trip"),
            exact.ratio(F.col("total_tips"), trips).alias("tips_per_trip"),
            "avg_tip_percentage",
        )
    )


def top_revenue_days(daily: DataFrame, days: int = 10) -> DataFrame:
    ranked = daily.orderBy(F.desc("total_revenue"), "pickup_date").limit(days)
    return ranked.select("pickup_date", "total_revenue", "total_trips")


def kpi_totals(daily: DataFrame) -> DataFrame:
    summed = daily.agg(
        F.sum("total_trips").alias("total_trips"), *exact.sums("revenue", F.col("total_revenue"))
    )
    return summed.select("total_trips", exact.total("revenue").alias("total_revenue"))


def monthly_revenue_summary(daily: DataFrame) -> DataFrame:
    """Averages are those of the daily averages, each day counting once."""
    summed = daily.groupBy("year", "month").agg(
        F.sum("total_trips").alias("monthly_trips"),
        *exact.sums("revenue", F.col("total_revenue")),
        *exact.sums("tips", F.col("total_tips")),
        *exact.sums("distance", F.col("avg_trip_distance")),
        *exact.sums("duration", F.col("avg_trip_duration")),
    )
    return summed.select(
        "year",
        "month",
        "monthly_trips",
        exact.total("revenue").alias("monthly_revenue"),
        exact.total("tips").alias("monthly_tips"),
        exact.mean("distance").alias("avg_distance"),
        exact.mean("duration").alias("avg_duration"),
    ).orderBy(F.desc("year"), F.desc("month"))


def peak_hours(hourly: DataFrame, year: int = YEAR, month: int = MONTH, rows: int = 20):
    return (
        in_partition(hourly, year, month)
        .orderBy(F.desc("trip_count"), "pickup_day_of_week", "pickup_hour")
        .limit(rows)
        .select(
            "pickup_hour", "day_name", "trip_count", "avg_fare", "avg_distance", "avg_duration"
        )
    )


def _hourly_averages(hourly: DataFrame, *keys: str | Column) -> DataFrame:
    return hourly.groupBy(*keys).agg(
        F.sum("trip_count").alias("total_trips"),
        *[
            part
            for name in ("fare", "distance", "duration")
            for part in exact.sums(name, F.col(f"avg_{name}"))
        ],
    )


def weekend_vs_weekday(hourly: DataFrame, year: int = YEAR, month: int = MONTH) -> DataFrame:
    """Averages of the hourly averages, each hour counting once."""
    day_type = labels.day_type(F.col("pickup_day_of_week")).alias("day_type")
    return (
        _hourly_averages(in_partition(hourly, year, month), day_type)
        .select(
            "day_type",
            "total_trips",
            exact.mean("fare").alias("avg_fare"),
            exact.mean("distance").alias("avg_distance"),
            exact.mean("duration").alias("avg_duration"),
        )
        .orderBy("day_type")
    )


def metrics_by_day_of_week(hourly: DataFrame, year: int = YEAR, month: int = MONTH) -> DataFrame:
    grouped = _hourly_averages(
        in_partition(hourly, year, month), "day_name", "pickup_day_of_week"
    )
    return grouped.orderBy("pickup_day_of_week").select(
        "day_name",
        "total_trips",
        exact.mean("fare").alias("avg_fare"),
        exact.mean("distance").alias("avg_distance"),
        exact.mean("duration").alias("avg_duration_minutes"),
    )


def _share_of_month(count: str) -> Column:
    # One month is one window partition, so the total is the month's and never one task's whole table.
    whole_month = Window.partitionBy("year", "month")
    return exact.percentage(F.col(count), F.sum(count).over(whole_month))


def payment_preferences(payment: DataFrame, year: int = YEAR, month: int = MONTH) -> DataFrame:
    count = F.col("transaction_count")
    return (
        in_partition(payment, year, month)
        .withColumn("percentage_of_total", _share_of_month("transaction_count"))
        .orderBy(F.desc("transaction_count"), "payment_type")
        .select(
            "payment_method",
            "transaction_count",
            "total_revenue",
            exact.ratio(F.col("total_revenue"), count).alias("avg_transaction_value"),
            "avg_tip_percentage",
            "percentage_of_total",
        )
    )


def distance_distribution_report(
    distance: DataFrame, year: int = YEAR, month: int = MONTH
) -> DataFrame:
    return (
        in_partition(distance, year, month)
        .withColumn("percentage_of_trips", _share_of_month("trip_count"))
        .orderBy(labels.distance_bucket_rank(F.col("distance_bucket")))
        .select(
            "distance_bucket",
            "trip_count",
            "total_revenue",
            "avg_fare",
            "avg_duration",
            "percentage_of_trips",
        )
    )


# --- processed layer -------------------------------------------------------------------------


def high_value_trips(
    trips: DataFrame, year: int = YEAR, month: int = MONTH, above: float = 100, rows: int = 50
) -> DataFrame:
    return (
        in_partition(trips, year, month)
        .filter(F.col("total_amount") > above)
        .orderBy(F.desc("total_amount"), "pickup_datetime", "dropoff_datetime")
        .limit(rows)
        .select(
            F.to_date("pickup_datetime").alias("trip_date"),
            "pickup_datetime",
            "dropoff_datetime",
            "trip_distance",
            "trip_duration_minutes",
            "fare_amount",
            "tip_amount",
            "total_amount",
            "tip_percentage",
        )
    )


def tip_by_trip_category(trips: DataFrame, year: int = YEAR, month: int = MONTH) -> DataFrame:
    """Card payments with a tip."""
    tipped = in_partition(trips, year, month).filter("payment_type = 1 AND tip_amount > 0")
    summed = tipped.groupBy(labels.trip_category(F.col("trip_distance")).alias("trip_category"))
    return (
        summed.agg(
            F.count(F.lit(1)).alias("trip_count"),
            *exact.sums("share", F.col("tip_percentage")),
            *exact.sums("tip", F.col("tip_amount")),
            *exact.sums("fare", F.col("fare_amount")),
        )
        .select(
            "trip_category",
            "trip_count",
            exact.mean("share").alias("avg_tip_percentage"),
            exact.mean("tip").alias("avg_tip_amount"),
            exact.mean("fare").alias("avg_fare"),
        )
        .orderBy(F.desc("avg_tip_percentage"))
    )


def data_quality_check(trips: DataFrame, year: int = YEAR, month: int = MONTH) -> DataFrame:
    summed = (
        in_partition(trips, year, month)
        .groupBy("year", "month")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_distinct("day").alias("days_with_data"),
            F.min("pickup_datetime").alias("earliest_trip"),
            F.max("pickup_datetime").alias("latest_trip"),
            *exact.sums("distance", F.col("trip_distance")),
            *exact.sums("fare", F.col("fare_amount")),
        )
    )
    return summed.select(
        "year",
        "month",
        "total_records",
        "days_with_data",
        "earliest_trip",
        "latest_trip",
        exact.mean("distance").alias("avg_distance"),
        exact.mean("fare").alias("avg_fare"),
    )


def data_quality_global(trips: DataFrame, year: int = YEAR, month: int = MONTH) -> DataFrame:
    """One row for the month, averages not rounded. Processed trips have no vendor column, so the
    distinct count is that of payment types."""
    summed = in_partition(trips, year, month).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("payment_type").alias("unique_payment_types"),
        F.min("pickup_datetime").alias("earliest_trip"),
        F.max("pickup_datetime").alias("latest_trip"),
        *exact.sums("distance", F.col("trip_distance")),
        *exact.sums("fare", F.col("fare_amount")),
    )
    return summed.select(
        "total_records",
        "unique_payment_types",
        "earliest_trip",
        "latest_trip",
        exact.unrounded_mean("distance").alias("avg_distance"),
        exact.unrounded_mean("fare").alias("avg_fare"),
    )


def storage_estimate(trips: DataFrame, gb_per_record: str = GB_PER_RECORD) -> DataFrame:
    factor = F.lit(gb_per_record).cast("decimal(12,10)")
    estimate = F.round(F.col("record_count").cast("decimal(20,0)") * factor, 4)
    return (
        trips.groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("estimated_storage_gb", estimate.cast("double"))
        .orderBy(F.desc("year"), F.desc("month"))
    )


def benchmark_partition_agg(
    trips: DataFrame, year: int = YEAR, month: int = MONTH, day: int = 15
) -> DataFrame:
    summed = in_partition(trips, year, month, day).agg(
        F.count(F.lit(1)).alias("total_trips"),
        *exact.sums("fare", F.col("fare_amount")),
        *exact.sums("total", F.col("total_amount")),
    )
    return summed.select(
        "total_trips",
        exact.mean("fare").alias("avg_fare"),
        exact.total("total").alias("total_revenue"),
    )


def count_trips(trips: DataFrame, year: int, month: int, day: int | None = None) -> DataFrame:
    return in_partition(trips, year, month, day).agg(F.count(F.lit(1)).alias("total_trips"))


def partition_distribution(trips: DataFrame, year: int = YEAR) -> DataFrame:
    return (
        in_partition(trips, year)
        .groupBy("year", "month", "day")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy("year", "month", "day")
    )


def picked_up_after(trips: DataFrame, moment: str) -> DataFrame:
    """Trips after a moment. The bound on the day keys is implied by it, and lets a stored table
    skip the partitions before that day."""
    start = F.to_timestamp(F.lit(moment))
    first_day = F.to_date(start)
    day = F.make_date("year", "month", "day")
    return trips.filter(
        (F.col("year") >= F.year(start))
        & (day >= first_day)
        & (F.col("pickup_datetime") > start)
    )
