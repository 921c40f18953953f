"""Compaction in place, for lakes that are kept by a ledger.

Small batches are copied together into larger ones: trips, cells, rejects, ledger entries and audit counts. The copies are
invisible until one record retires the old batches and adds the new ones, so that a reader sees either set and never
both or half. The old batches stay until ``ledger.remove_invisible``; up to then ``ledger.rewind`` takes the compaction
back. A compaction that crashed leaves batches that no run shows, and the next one starts afresh.

A merged batch remembers all files it was made from. If one of them is rewritten the whole batch is retired and its other
files are read again, which is why batches are merged only up to a number of files and bytes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.plans import curated, publish
from meterline.sources import layers, lease
from meterline.sources.layers import INGEST_BATCH, Lake
from meterline.sources.lease import Lease
from meterline.sources.schemas import DAY_KEYS, MONTH_KEYS
from meterline.streaming import ingest, ledger


def groups(spark: SparkSession, lake: Lake, max_files: int, max_bytes: int) -> list[list[str]]:
    """Neighbouring batches, in the order of their names, that fit together into one; those that stay alone are left out.

    What reaches the driver is a row a visible batch, as many as the record of a run lists."""
    read = ledger.entries(spark, lake).groupBy(INGEST_BATCH).agg(F.count("*").alias("n"), F.sum("length").alias("size"))
    found: list[list[str]] = []
    files = size = 0
    for row in read.orderBy(INGEST_BATCH).collect():
        files, size = files + row.n, size + row.size
        if not found or files > max_files or size > max_bytes:
            found.append([])
            files, size = row.n, row.size
        found[-1].append(row[INGEST_BATCH])
    return [group for group in found if len(group) > 1]


def compact(
    spark: SparkSession, lake: Lake, max_files: int = ledger.FILES, max_bytes: int = ledger.BYTES, holder: str = ""
) -> list[str] | None:
    """Merge small batches and return the new ones; None while another writer holds the lease."""
    with lease.held(spark, lake, holder) as held:
        return None if held is None else _compact(spark, lake, held, max_files, max_bytes)


def _compact(spark: SparkSession, lake: Lake, held: Lease, max_files: int, max_bytes: int) -> list[str]:
    before = ledger.state(spark, lake)
    merged: dict[str, list[str]] = {}
    attempt = uuid.uuid4().hex[:12]
    for piece, old in enumerate(groups(spark, lake, max_files, max_bytes)):
        batch = f"{ledger.TAG}{before.run + 1:06d}-{attempt}-m{piece:05d}"
        _merge(spark, lake, old, batch)
        merged[batch] = old
        held.renew(spark)
    if merged:
        retired = [name for old in merged.values() for name in old]
        ledger.add_run(spark, lake, before, list(merged), retired, "compaction", held)
        publish.renamed(spark, lake, merged, held)
    return list(merged)


def _merge(spark: SparkSession, lake: Lake, old: list[str], batch: str) -> None:
    def batches(path: str) -> DataFrame | None:
        found = layers.if_present(lambda: layers.read_batches(spark, path))
        return found if found is None else found.where(F.col(INGEST_BATCH).isin(*old))

    def write(frame: DataFrame, path: str, keys: tuple[str, ...] = ()) -> None:
        layers.write_ingest_batch(frame.drop(INGEST_BATCH), path, batch, keys, replace=False)

    counts = batches(lake.audit).agg(
        F.sum("files").alias("files"),
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_kept").alias("rows_kept"),
        F.sum("rows_rejected").alias("rows_rejected"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("months")))).alias("months"),
    )
    totals = counts.first().asDict()
    if totals["rows_kept"]:
        write(batches(lake.processed), lake.processed, DAY_KEYS)
        copied = batches_of(layers.read_batches(spark, lake.processed), batch).count()
        if copied != totals["rows_kept"]:
            raise RuntimeError(f"{batch} has {copied} trips, and the batches it was made from {totals['rows_kept']}")
        write(curated.merged_cells(batches(lake.cells).drop(INGEST_BATCH)), lake.cells, MONTH_KEYS)
    if totals["rows_rejected"]:
        write(batches(lake.rejects), lake.rejects)
    write(batches(lake.ledger), lake.ledger)
    ingest._write_audit(spark, lake, batch, totals.pop("files"), totals)


def batches_of(frame: DataFrame, batch: str) -> DataFrame:
    return frame.where(F.col(INGEST_BATCH) == batch)
