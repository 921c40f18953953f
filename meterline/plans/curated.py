"""The four curated tables.

Each table is a list of keys and of output columns. It can be built straight from trips, or from
*cells*: one row of partial sums per day, hour, payment type and distance bucket. Cells are what the
rebuild of all four tables uses, so that the processed layer is read once and not four times, and
what is shuffled is bounded by the number of cells, not of trips: a day that holds a third of all
trips is still reduced to its few hundred cells inside each map task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions import exact, labels
from meterline.operators.trips import with_time_dimensions
from meterline.sources.schemas import PARQUET_TABLES

SECONDS_PER_MINUTE = 60

# What is summed. Durations are whole seconds, so they are summed as seconds and not as minutes.
_MEASURES: dict[str, Column | str] = {
    "distance": "trip_distance",
    "fare": "fare_amount",
    "tip": "tip_amount",
    "total": "total_amount",
    "passengers": "passenger_count",
    "tip_share": "tip_percentage",
    "seconds": "trip_duration_minutes",
}


def _measured(name: str) -> Column:
    column = F.col(_MEASURES[name])
    return column * SECONDS_PER_MINUTE if name == "seconds" else column


@dataclass(frozen=True)
class Output:
    kind: str
    measure: str = ""

    def column(self) -> Column:
        if self.kind == "count":
            return F.col("trips")
        if self.kind == "sum":
            return exact.total(self.measure)
        if self.kind == "mean":
            divisor = SECONDS_PER_MINUTE if self.measure == "seconds" else 1
            return exact.mean(self.measure, divisor)
        return F.col(f"{self.measure}_{self.kind}")


@dataclass(frozen=True)
class CuratedTable:
    name: str
    keys: tuple[str, ...]
    outputs: dict[str, Output]
    label: tuple[str, str] | None = None

    @property
    def catalog_name(self) -> str:
        return f"curated_{self.name}"

    @property
    def measures(self) -> list[str]:
        used = {output.measure for output in self.outputs.values()}
        return [name for name in _MEASURES if name in used]


COUNT = Output("count")
DAILY = CuratedTable(
    "daily_trip_statistics",
    ("year", "month", "day", "pickup_date"),
    {
        "total_trips": COUNT,
        "total_revenue": Output("sum", "fare"),
        "total_tips": Output("sum", "tip"),
        "avg_trip_distance": Output("mean", "distance"),
        "avg_trip_duration": Output("mean", "seconds"),
        "avg_passengers": Output("mean", "passengers"),
        "avg_tip_percentage": Output("mean", "tip_share"),
        "max_fare": Output("max", "fare"),
        "min_fare": Output("min", "fare"),
    },
)
HOURLY = CuratedTable(
    "hourly_trip_patterns",
    ("year", "month", "pickup_hour", "pickup_day_of_week"),
    {
        "trip_count": COUNT,
        "avg_distance": Output("mean", "distance"),
        "avg_duration": Output("mean", "seconds"),
        "avg_fare": Output("mean", "fare"),
        "avg_passengers": Output("mean", "passengers"),
    },
    label=("day_name", "pickup_day_of_week"),
)
PAYMENT = CuratedTable(
    "payment_type_analysis",
    ("year", "month", "payment_type"),
    {
        "transaction_count": COUNT,
        "total_revenue": Output("sum", "total"),
        "avg_tip_percentage": Output("mean", "tip_share"),
        "avg_fare": Output("mean", "fare"),
    },
    label=("payment_method", "payment_type"),
)
DISTANCE = CuratedTable(
    "distance_distribution",
    ("year", "month", "distance_bucket"),
    {
        "trip_count": COUNT,
        "avg_fare": Output("mean", "fare"),
        "avg_duration": Output("mean", "seconds"),
        "total_revenue": Output("sum", "total"),
    },
)
TABLES = (DAILY, HOURLY, PAYMENT, DISTANCE)

_LABELS = {"day_name": labels.day_name, "payment_method": labels.payment_method}
_CELL_KEYS = list(dict.fromkeys(key for table in TABLES for key in table.keys))


def _with_dimensions(trips: DataFrame) -> DataFrame:
    bucket = labels.distance_bucket(F.col("trip_distance"))
    return with_time_dimensions(trips).withColumn("distance_bucket", bucket)


def _summed(trips: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    parts = [part for name in measures for part in exact.sums(name, _measured(name))]
    return trips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips"),
        F.max("fare_amount").alias("fare_max"),
        F.min("fare_amount").alias("fare_min"),
        *parts,
    )


def _summed_again(cells: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    parts = [part for name in measures for part in exact.sums_of_sums(name)]
    return cells.groupBy(*keys).agg(
        F.sum("trips").alias("trips"),
        F.max("fare_max").alias("fare_max"),
        F.min("fare_min").alias("fare_min"),
        *parts,
    )


def _finished(table: CuratedTable, summed: DataFrame) -> DataFrame:
    columns = [F.col(key) for key in table.keys]
    columns += [output.column().alias(name) for name, output in table.outputs.items()]
    if table.label:
        name, key = table.label
        columns.append(_LABELS[name](F.col(key)).alias(name))
    declared, partitions = PARQUET_TABLES[table.catalog_name]
    order = [field.split()[0] for field in declared.split(",")]
    return summed.select(*columns).select(*order, *partitions)


def from_trips(table: CuratedTable, trips: DataFrame) -> DataFrame:
    summed = _summed(_with_dimensions(trips), list(table.keys), table.measures)
    return _finished(table, summed)


def cells(trips: DataFrame) -> DataFrame:
    return _summed(_with_dimensions(trips), _CELL_KEYS, list(_MEASURES))


def from_cells(table: CuratedTable, cell_rows: DataFrame) -> DataFrame:
    return _finished(table, _summed_again(cell_rows, list(table.keys), table.measures))


def merged_cells(cell_rows: DataFrame) -> DataFrame:
    """Cells of several batches as those of one."""
    return _summed_again(cell_rows, _CELL_KEYS, list(_MEASURES))
