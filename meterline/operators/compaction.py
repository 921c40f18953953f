"""Fewer, larger files for chosen partitions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from meterline.sources import layers
from meterline.sources.schemas import DAY_KEYS


def compact_trips(
    spark: SparkSession,
    source: str,
    target: str,
    where: str = "true",
    max_records_per_file: int = 5_000_000,
    compression: str = "snappy",
) -> int:
    """Copy the partitions that meet ``where`` to a new folder with few files each.

    The source stays as it is, so a reader never sees a half-written partition and a lost job loses
    nothing: point the table at the new folder once the copy is there. Files of several ingest
    batches of a day are merged into one, so later batches can be ingested beside it. Returns the rows copied.
    """
    trips = layers.read_processed(spark, source).filter(F.expr(where))
    (
        layers.by_partition(trips, *DAY_KEYS)
        .withColumn(layers.INGEST_BATCH, F.lit("compacted"))
        .write.mode("errorifexists")
        .partitionBy(*DAY_KEYS, layers.INGEST_BATCH)
        .option("compression", compression)
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(target)
    )
    # Both counts come from file footers.
    copied = layers.read_processed(spark, target).count()
    if copied != trips.count():
        raise RuntimeError(f"{target} has {copied} rows, which is not what {source} holds")
    return copied
