"""Age tiers and retention of day partitions. These only report; nothing is moved or deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sources.schemas import DAY_KEYS

# Days after which a partition moves to a colder tier, and after which it may go.
TIERS = {
    "raw": ((30, "infrequent"), (90, "archive"), (180, "deep_archive")),
    "processed": ((60, "infrequent"), (180, "archive")),
    "curated": ((90, "infrequent"),),
}
RETENTION_DAYS = {"raw": 365, "processed": 730}
FIRST_TIER = "standard"


def partitions_of(trips: DataFrame) -> DataFrame:
    return trips.select(*DAY_KEYS).distinct()


def partitions_in_catalog(spark: SparkSession, table: str) -> DataFrame:
    """Day partitions from the catalog alone: no data file is opened."""
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    values = [
        F.regexp_extract("partition", f"{key}=([0-9]+)", 1).cast("int").alias(key)
        for key in DAY_KEYS
    ]
    return listed.select(*values).distinct()


def _with_age(partitions: DataFrame, as_of: str) -> DataFrame:
    age = F.date_diff(F.to_date(F.lit(as_of)), F.make_date(*DAY_KEYS))
    return partitions.select(*DAY_KEYS, age.cast("bigint").alias("age_days"))


def _tier(layer: str) -> Column:
    label = F.lit(FIRST_TIER)
    for days, name in TIERS[layer]:
        label = F.when(F.col("age_days") >= days, name).otherwise(label)
    return label


def age_tiers(partitions: DataFrame, as_of: str) -> DataFrame:
    """The tier of each day partition in each layer on a date."""
    per_layer = [F.struct(F.lit(name).alias("layer"), _tier(name).alias("tier")) for name in TIERS]
    aged = _with_age(partitions, as_of)
    return aged.select(F.inline(F.array(*per_layer)), *DAY_KEYS, "age_days")


def expired(partitions: DataFrame, as_of: str) -> DataFrame:
    """Day partitions that are past the retention of their layer."""
    limits = [
        F.struct(F.lit(name).alias("layer"), F.lit(days).alias("kept_days"))
        for name, days in RETENTION_DAYS.items()
    ]
    aged = _with_age(partitions, as_of).select(F.inline(F.array(*limits)), *DAY_KEYS, "age_days")
    return aged.filter("age_days > kept_days").drop("kept_days")
