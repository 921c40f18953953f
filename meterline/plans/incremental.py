"""Curated tables kept up to date from stored cells, at the cost of what has changed.

Each batch of the ledger stores its cells, partial sums that merge exactly. A publication compares the batches it would
cover with those of the set before, finds the months in which added or retired batches have cells, and merges all
visible cells of these months. Trips are never read again, and other months keep their version.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.plans import curated, publish
from meterline.sources import journal, layers, lease
from meterline.sources.layers import INGEST_BATCH, Lake
from meterline.sources.lease import Lease
from meterline.streaming import ledger


def stored_cells(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Cells of all batches, visible or not, with their batch."""
    return layers.if_present(lambda: layers.read_batches(spark, lake.cells))


def publish_changes(spark: SparkSession, lake: Lake, held: Lease | None = None) -> int | None:
    """Publish the months that differ from the set before; None if no batch differs."""
    visible = ledger.state(spark, lake).batches
    before = journal.latest(spark, lake.published)
    covered = set(before["batches"]) if before else set()
    changed = covered ^ set(visible)
    cells = stored_cells(spark, lake)
    if not changed or cells is None:
        return None
    # Both are partition columns, so this lists folders and reads no file.
    touched = cells.where(F.col(INGEST_BATCH).isin(*changed)).select("year", "month").distinct().collect()
    months = [(row.year, row.month) for row in touched]
    of_months = [(F.col("year") == year) & (F.col("month") == month) for year, month in months]
    wanted = ledger.visible(cells, visible).where(reduce(or_, of_months, F.lit(False))).drop(INGEST_BATCH)
    return publish.publish(spark, lake, wanted, months, visible, held)


def update(spark: SparkSession, lake: Lake, holder: str = "", seconds: float = lease.SECONDS) -> list[str] | None:
    """Ingest what is new or changed and publish; the batches, or None while another writer holds the lease."""
    with lease.held(spark, lake, holder, seconds) as held:
        if held is None:
            return None
        batches = ledger.ingest_changes(spark, lake, held)
        publish_changes(spark, lake, held)
        return batches


def rewind(spark: SparkSession, lake: Lake, run: int) -> list[str] | None:
    """Take the lake back to what it was after a run, and publish that."""
    with lease.held(spark, lake) as held:
        if held is None:
            return None
        retired = ledger.rewind(spark, lake, run, held)
        publish_changes(spark, lake, held)
        return retired


def full_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The four tables straight from the visible trips, to compare with what is published."""
    trips = ledger.read_visible(spark, lake)
    return {table.name: curated.from_trips(table, trips) for table in curated.TABLES}
