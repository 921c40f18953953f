"""Small raw and processed trips for tests."""

from __future__ import annotations

from meterline.operators import trips
from meterline.sources.schemas import RAW_USED

GOOD = {
    "tpep_pickup_datetime": "2024-01-15 10:00:00",
    "tpep_dropoff_datetime": "2024-01-15 10:30:00",
    "passenger_count": "2",
    "trip_distance": "5.5",
    "fare_amount": "25.50",
    "tip_amount": "5.00",
    "total_amount": "31.50",
    "payment_type": "1",
}
HEADER = "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,"
HEADER += "fare_amount,tip_amount,total_amount,payment_type"
LINE = "1,2024-01-15 10:00:00,2024-01-15 10:30:00,2,5.5,25.50,5.00,31.50,1"
RAW_SCHEMA = ", ".join(f"{name} STRING" for name in RAW_USED)


def raw(spark, *changes):
    rows = [tuple({**GOOD, **change}[name] for name in RAW_USED) for change in changes or [{}]]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def processed(spark, *changes):
    return trips.processed_trips(raw(spark, *changes))
