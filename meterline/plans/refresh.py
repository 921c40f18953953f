"""From new raw files to fresh curated tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.plans import curated, publish
from meterline.session import shared_folder
from meterline.sources import layers, lease
from meterline.sources.layers import Lake
from meterline.streaming.ingest import ingest_new_files

Month = tuple[int, int]


def _of_months(trips: DataFrame, months: Sequence[Month]) -> DataFrame:
    chosen = [(F.col("year") == year) & (F.col("month") == month) for year, month in months]
    return trips.filter(reduce(or_, chosen))


def rebuild_curated(
    spark: SparkSession, lake: Lake, months: Sequence[Month] | None = None
) -> bool:
    """Publish the four curated tables from the processed layer, all months or whole chosen ones.

    The processed layer is read once, into cells of partial sums. The cells are checkpointed in the
    shared folder, so that the four writes neither read the trips again nor depend on executors that
    may be lost. Readers see the set published before until all four are written. Returns False, and
    publishes nothing, when there are no trips.
    """
    trips = layers.if_present(lambda: layers.read_processed(spark, lake.processed))
    if trips is None or (months is not None and not months):
        return False
    if months is not None:
        trips = _of_months(trips, months)
    shared_folder(spark)
    cells = curated.cells(trips).checkpoint()
    if cells.isEmpty():
        return False
    publish.publish(spark, lake, cells, months)
    return True


def _audit(spark: SparkSession, lake: Lake) -> DataFrame | None:
    return layers.if_present(lambda: layers.read_batches(spark, lake.audit))


def months_of_batches(spark: SparkSession, lake: Lake, batches: Sequence[str]) -> list[Month]:
    """Months that ingest batches wrote to, as their audit rows tell."""
    audit = _audit(spark, lake)
    if audit is None:
        return []
    months = audit.filter(F.col(layers.INGEST_BATCH).isin(*batches)).select(F.explode("months").alias("m"))
    return [(row.m // 100, row.m % 100) for row in months.distinct().orderBy("m").collect()]


def batches_to_rebuild(spark: SparkSession, lake: Lake) -> list[str]:
    """Ingested batches that no complete rebuild has covered, such as those of a run that failed between the two."""
    audit = _audit(spark, lake)
    if audit is None:
        return []
    known = audit.select(layers.INGEST_BATCH)
    rebuilt = layers.if_present(lambda: spark.read.schema(f"{layers.INGEST_BATCH} STRING").parquet(lake.rebuilt))
    if rebuilt is not None:
        known = known.join(rebuilt, layers.INGEST_BATCH, "left_anti")
    return sorted(row[0] for row in known.distinct().collect())


def refresh(spark: SparkSession, lake: Lake, only_new_months: bool = False) -> list[str]:
    """Ingest new raw files, then rebuild the curated tables if any batch is not in them yet.

    A batch is noted once all four tables are published, so a refresh after a failed one makes up for it. While
    another refresh of the lake runs this one does nothing: the files are still new for the next."""
    with lease.held(spark, lake) as held:
        return _refreshed(spark, lake, only_new_months) if held else []


def _refreshed(spark: SparkSession, lake: Lake, only_new_months: bool) -> list[str]:
    batches = ingest_new_files(spark, lake)
    pending = batches_to_rebuild(spark, lake)
    if pending:
        months = months_of_batches(spark, lake, pending) if only_new_months else None
        rebuild_curated(spark, lake, months)
        noted = spark.createDataFrame([(name,) for name in pending], f"{layers.INGEST_BATCH} STRING")
        noted.coalesce(1).write.mode("append").parquet(lake.rebuilt)
    return batches
