"""From raw text to typed, derived and dated trips. Every step is narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.casts import to_double, to_int, to_time
from meterline.operators import quality
from meterline.sources.schemas import PROCESSED_COLUMNS, RAW_USED

# typed name -> (raw name, parser)
_TYPED = {
    "pickup_datetime": ("tpep_pickup_datetime", to_time),
    "dropoff_datetime": ("tpep_dropoff_datetime", to_time),
    "passenger_count": ("passenger_count", to_int),
    "trip_distance": ("trip_distance", to_double),
    "fare_amount": ("fare_amount", to_double),
    "tip_amount": ("tip_amount", to_double),
    "total_amount": ("total_amount", to_double),
    "payment_type": ("payment_type", to_int),
}
TYPED_COLUMNS = tuple(_TYPED)


def typed_trips(raw: DataFrame, *carried: str | Column) -> DataFrame:
    """Parse the used text columns; ``carried`` columns pass through beside them.

    The columns that rules test come out of a one-row ``inline``. Without it the optimizer moves a
    filter below the parsing and parses the text again for each rule that names the column, which
    made the whole transform seven times slower on the benchmark table.
    """
    parsed = {name: parse(F.col(source)).alias(name) for name, (source, parse) in _TYPED.items()}
    tested = [parsed[name] for name in quality.TESTED_COLUMNS]
    others = [parsed[name] for name in parsed if name not in quality.TESTED_COLUMNS]
    frame = raw.select(F.inline(F.array(F.struct(*tested))), *others, *carried)
    return frame.select(*TYPED_COLUMNS, *frame.columns[len(TYPED_COLUMNS) :])


def raw_row(raw: DataFrame) -> Column:
    """The raw record, whatever columns its file had."""
    return F.struct(*[F.col(name) for name in raw.columns]).alias("raw_record")


def with_metrics(trips: DataFrame) -> DataFrame:
    minutes = (F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")) / 60
    miles, fare, tip = F.col("trip_distance"), F.col("fare_amount"), F.col("tip_amount")
    duration = F.col("trip_duration_minutes")
    speed = F.when(duration > 0, F.round(miles / duration * 60, 2)).otherwise(0.0)
    tip_share = F.when(fare > 0, F.round(tip / fare * 100, 2)).otherwise(0.0)
    return trips.withColumn("trip_duration_minutes", minutes).withColumns(
        {"avg_speed_mph": speed, "tip_percentage": tip_share}
    )


def with_day_keys(trips: DataFrame) -> DataFrame:
    pickup = F.col("pickup_datetime")
    return trips.withColumns(
        {"year": F.year(pickup), "month": F.month(pickup), "day": F.dayofmonth(pickup)}
    )


def finished_trips(kept: DataFrame) -> DataFrame:
    """Trips that passed every rule, in the columns of the processed layer."""
    return with_day_keys(with_metrics(kept)).select(*PROCESSED_COLUMNS)


def processed_trips(raw: DataFrame) -> DataFrame:
    return finished_trips(quality.kept(typed_trips(raw)))


def with_time_dimensions(trips: DataFrame) -> DataFrame:
    pickup = F.col("pickup_datetime")
    return trips.withColumns(
        {
            "pickup_hour": F.hour(pickup),
            "pickup_day_of_week": F.dayofweek(pickup),
            "pickup_date": F.to_date(pickup),
        }
    )


def with_used_columns(raw: DataFrame) -> DataFrame:
    """Add used columns that the files lack as NULL, so that the rules can name them."""
    present = {name.lower() for name in raw.columns}
    absent = {name: F.lit(None).cast("string") for name in RAW_USED if name not in present}
    return raw.withColumns(absent) if absent else raw
