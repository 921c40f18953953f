"""Column layouts of the three layers (fixed values)."""

from __future__ import annotations

# Text columns of the raw layer that the trip transform reads.
RAW_USED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
)

RAW_TABLE = """
    tpep_pickup_datetime STRING, tpep_dropoff_datetime STRING, passenger_count INT,
    trip_distance DOUBLE, pickup_longitude DOUBLE, pickup_latitude DOUBLE, rate_code_id INT,
    store_and_fwd_flag STRING, dropoff_longitude DOUBLE, dropoff_latitude DOUBLE,
    payment_type INT, fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE,
    tolls_amount DOUBLE, improvement_surcharge DOUBLE, total_amount DOUBLE,
    congestion_surcharge DOUBLE
"""

DAY_KEYS = ("year", "month", "day")
MONTH_KEYS = ("year", "month")

# name -> (columns, partition columns)
PARQUET_TABLES = {
    "processed_taxi_trips": (
        """
        pickup_datetime TIMESTAMP, dropoff_datetime TIMESTAMP, passenger_count INT,
        trip_distance DOUBLE, fare_amount DOUBLE, tip_amount DOUBLE, total_amount DOUBLE,
        payment_type INT, trip_duration_minutes DOUBLE, avg_speed_mph DOUBLE,
        tip_percentage DOUBLE
        """,
        DAY_KEYS,
    ),
    "curated_daily_trip_statistics": (
        """
        pickup_date DATE, day INT, total_trips BIGINT, total_revenue DOUBLE, total_tips DOUBLE,
        avg_trip_distance DOUBLE, avg_trip_duration DOUBLE, avg_passengers DOUBLE,
        avg_tip_percentage DOUBLE, max_fare DOUBLE, min_fare DOUBLE
        """,
        MONTH_KEYS,
    ),
    "curated_hourly_trip_patterns": (
        """
        pickup_hour INT, pickup_day_of_week INT, day_name STRING, trip_count BIGINT,
        avg_distance DOUBLE, avg_duration DOUBLE, avg_fare DOUBLE, avg_passengers DOUBLE
        """,
        MONTH_KEYS,
    ),
    "curated_payment_type_analysis": (
        """
        payment_type INT, payment_method STRING, transaction_count BIGINT, total_revenue DOUBLE,
        avg_tip_percentage DOUBLE, avg_fare DOUBLE
        """,
        MONTH_KEYS,
    ),
    "curated_distance_distribution": (
        """
        distance_bucket STRING, trip_count BIGINT, avg_fare DOUBLE, avg_duration DOUBLE,
        total_revenue DOUBLE
        """,
        MONTH_KEYS,
    ),
}


def read_schema(table: str) -> str:
    """DDL text of a table with its partition columns, which are all INT."""
    columns, keys = PARQUET_TABLES[table]
    return ", ".join([columns.strip(), *[f"{key} INT" for key in keys]])


PROCESSED_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
    "trip_duration_minutes",
    "avg_speed_mph",
    "tip_percentage",
    *DAY_KEYS,
)
