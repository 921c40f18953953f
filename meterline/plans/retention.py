"""Removal of day partitions past their retention: first a plan, then an explicit call that applies it.

The plan lists each expired day of processed trips with a fingerprint of its files (path, length, modification time).
Applying it looks at the files again and removes only days whose fingerprint is still the planned one, so a day that got
late rows, or was compacted or replaced after somebody looked at the plan, stays. It holds the lake's lease, so no
writer can add to a day between the look and the removal. A run that failed half way is made up for by applying the
same plan again. Curated tables keep a removed day until its month is rebuilt; a catalog needs its partitions repaired.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import lifecycle
from meterline.sources import journal, lease
from meterline.sources.layers import Lake, if_present
from meterline.sources.schemas import DAY_KEYS

LAYER = "processed"
_PLAN = "year INT, month INT, day INT, age_days BIGINT, files BIGINT, bytes BIGINT, fingerprint STRING"


def _days(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Files, bytes and fingerprint of each day folder. Only names are read, and a sum of hashes needs no order."""

    def listed() -> DataFrame:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        return reader.load(lake.processed).select("path", "length", "modificationTime")

    found = if_present(listed)
    if found is None:
        return None
    folder = "/year=([0-9]+)/month=([0-9]+)/day=([0-9]+)/"
    keys = [F.regexp_extract("path", folder, i).cast("int").alias(key) for i, key in enumerate(DAY_KEYS, 1)]
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    days = found.where(F.col("path").rlike(folder)).select(*keys, "length", mark.alias("mark"))
    return days.groupBy(*DAY_KEYS).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.sum("mark").cast("string").alias("fingerprint")
    )


def plan(spark: SparkSession, lake: Lake, as_of: str) -> DataFrame:
    """The days that may go on a date, with the fingerprint of their files. Nothing is removed."""
    days = _days(spark, lake)
    if days is None:
        return spark.createDataFrame([], _PLAN)
    gone = lifecycle.expired(days, as_of).where(F.col("layer") == LAYER).drop("layer")
    return gone.join(days, list(DAY_KEYS)).select(*DAY_KEYS, "age_days", "files", "bytes", "fingerprint")


def apply(spark: SparkSession, lake: Lake, planned: DataFrame, as_of: str) -> DataFrame | None:
    """(year, month, day, outcome) of every planned day: ``removed``, ``changed`` since the plan and so kept, or
    ``absent``: already removed, or not past its retention on ``as_of``. None while another writer is active.

    ``planned`` is a plan that was stored, or a reviewed part of it. What reaches the driver are names of days."""
    with lease.held(spark, lake, "retention") as mine:
        if mine is None:
            return None
        now = plan(spark, lake, as_of).select(*DAY_KEYS, F.col("fingerprint").alias("now"))
        outcome = F.when(F.col("now").isNull(), "absent").when(F.col("now") != F.col("fingerprint"), "changed").otherwise("removed")
        judged = planned.dropDuplicates([*DAY_KEYS, "fingerprint"]).join(now, list(DAY_KEYS), "left").select(*DAY_KEYS, outcome.alias("outcome"))
        rows = judged.collect()
        for row in rows:
            if row.outcome == "removed":
                mine.renew(spark)
                mine.check(spark)
                journal.delete(spark, f"{lake.processed}/year={row.year}/month={row.month}/day={row.day}")
    return spark.createDataFrame(rows, "year INT, month INT, day INT, outcome STRING")
