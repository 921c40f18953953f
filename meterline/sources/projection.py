"""Day partitions found by their names instead of by listing.

The folders of a range of days are made from the range: whole months, and single days at its ends. They are handed to the
reader as one pattern of alternatives, for each of which the file system looks up one name; no folder above them is
listed, and no catalog has to be repaired before new days are seen. Thirty years are at most 420 names, whatever the number
of days and files in the lake. Days without a folder have no rows.

This suits reads of few days from a lake of many. A frame over the whole lake prunes as well, but first lists every folder.
"""

from __future__ import annotations

import calendar
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sources.layers import INGEST_BATCH, Lake, if_present
from meterline.sources.schemas import PROCESSED_COLUMNS, read_schema
from meterline.streaming import ledger

_TABLE = "processed_taxi_trips"


def folders(first: date, last: date) -> list[str]:
    """Folders of the days from ``first`` to ``last``, both included: a month where all of it is in the range."""
    found, at = [], first
    while at <= last:
        month = f"year={at.year}/month={at.month}"
        end = at.replace(day=calendar.monthrange(at.year, at.month)[1])
        if at.day == 1 and end <= last:
            found.append(month)
            at = end
        else:
            found.append(f"{month}/day={at.day}")
        if at == date.max:
            break
        at += timedelta(days=1)
    return found


def _as_date(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day


def read_days(spark: SparkSession, lake: Lake, first: date | str, last: date | str) -> DataFrame:
    """Visible processed trips of a range of days; none where the range is empty or has no folder."""
    names = folders(_as_date(first), _as_date(last))
    schema = f"{read_schema(_TABLE)}, {INGEST_BATCH} STRING"
    path = f"{lake.processed}/{{{','.join(names)}}}"
    reader = spark.read.schema(schema).option("basePath", lake.processed)
    trips = if_present(lambda: reader.parquet(path)) if names else None
    if trips is None:
        return spark.createDataFrame([], read_schema(_TABLE)).select(*PROCESSED_COLUMNS)
    return ledger.visible(trips, ledger.state(spark, lake).batches).select(*PROCESSED_COLUMNS)


def days_view(spark: SparkSession, lake: Lake, name: str, first: date | str, last: date | str) -> DataFrame:
    """The same as a view of the session, for SQL over a range of days that needs no table."""
    view = read_days(spark, lake, first, last).withColumn("pickup_day", F.make_date("year", "month", "day"))
    view.createOrReplaceTempView(name)
    return view
