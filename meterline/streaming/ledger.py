"""Ingest by a ledger of files, where raw files can be rewritten and runs taken back.

The ledger has a row for each file and batch: path, length and modification time as they were when the batch read it.
A run compares it with the listing, as tables: files it does not know are new, and files that changed are read again.
Runs are numbered records that say which batches they added and which they retired. A batch is visible from the run
that added it until a run that retires it, so that a crashed run shows nothing and replacing a batch is one record.
Rewinding is a run that retires what later runs added; their files are then new again.

A batch with a changed file is retired whole and its other files are read again beside it. If one of these is gone
from the raw folder its rows could not be made again, so such a batch stays and its changed file is listed as blocked.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import quality, trips
from meterline.plans import curated
from meterline.session import new_shared_path
from meterline.sources import journal, layers, raw_files
from meterline.sources.layers import INGEST_BATCH, Lake
from meterline.sources.lease import Lease
from meterline.sources.schemas import DAY_KEYS, MONTH_KEYS
from meterline.streaming import ingest

FILES = 5_000  # of a batch, about
BYTES = 64 << 30
TAG = "run-"
_ENTRY = f"path STRING, length BIGINT, modified_at TIMESTAMP, {INGEST_BATCH} STRING"


class RunLost(RuntimeError):
    """Another writer has added a run in the meantime."""


@dataclass(frozen=True)
class State:
    """The newest run and the batches that are visible after it."""

    run: int
    batches: tuple[str, ...]


def state(spark: SparkSession, lake: Lake) -> State:
    record = journal.latest(spark, lake.runs)
    return State(record["number"], tuple(record["visible"])) if record else State(0, ())


def visible(frame: DataFrame, batches: Iterable[str]) -> DataFrame:
    """Rows of visible batches, and of those that no run keeps, such as loads; a partition filter."""
    batch = F.col(INGEST_BATCH)
    return frame.filter(~batch.startswith(TAG) | batch.isin(*batches))


def read_visible(spark: SparkSession, lake: Lake) -> DataFrame:
    """The processed layer after the newest run."""
    schema = f"{layers.read_schema('processed_taxi_trips')}, {INGEST_BATCH} STRING"
    trips_ = spark.read.schema(schema).parquet(lake.processed)
    return visible(trips_, state(spark, lake).batches).select(*layers.PROCESSED_COLUMNS)


def entries(spark: SparkSession, lake: Lake) -> DataFrame:
    """What the visible batches have read."""
    known = layers.if_present(lambda: spark.read.schema(_ENTRY).parquet(lake.ledger))
    if known is None:
        return spark.createDataFrame([], _ENTRY)
    return visible(known, state(spark, lake).batches)


def files(spark: SparkSession, lake: Lake) -> DataFrame:
    """(path, length, modified_at, ingest_batch, status) of every file listed or known.

    The status is new, changed, blocked (changed, but a file of its batch is gone), again (unchanged, in a batch that
    is read again), gone or read. The listing and the ledger are joined in tasks."""
    notices = spark.read.format("binaryFile").options(**raw_files.file_options())
    listed = notices.load(lake.raw).select("path", "length", F.col("modificationTime").alias("modified_at"))
    known = entries(spark, lake).select(
        "path", F.col("length").alias("old_length"), F.col("modified_at").alias("old_time"), INGEST_BATCH
    )
    both = listed.join(known, "path", "full")
    changed = (F.col("length") != F.col("old_length")) | (F.col("modified_at") != F.col("old_time"))
    found = both.withColumn(
        "found",
        F.when(F.col(INGEST_BATCH).isNull(), "new").when(F.col("length").isNull(), "gone").when(changed, "changed").otherwise("read"),
    )
    batches = found.groupBy(INGEST_BATCH).agg(
        F.bool_or(F.col("found") == "changed").alias("has_changed"), F.bool_or(F.col("found") == "gone").alias("has_gone")
    )
    status = (
        F.when(F.col("has_changed") & F.col("has_gone") & (F.col("found") == "changed"), "blocked")
        .when(F.col("has_changed") & ~F.col("has_gone") & (F.col("found") == "read"), "again")
        .otherwise(F.col("found"))
    )
    joined = found.join(batches.where(F.col(INGEST_BATCH).isNotNull()), INGEST_BATCH, "left")
    return joined.select("path", "length", "modified_at", INGEST_BATCH, status.alias("status"))


def ingest_changes(
    spark: SparkSession, lake: Lake, lease: Lease | None = None, max_files: int = FILES, max_bytes: int = BYTES
) -> list[str]:
    """Read new and changed files as batches of about ``max_files`` and ``max_bytes``, and return the batches.

    Files are dealt to batches by a hash of their path; the driver sees the names of one batch at a time."""
    before = state(spark, lake)
    path = new_shared_path(spark, "ledger-plan")
    todo = files(spark, lake).where(F.col("status").isin("new", "changed", "again"))
    todo.withColumn("deal", F.xxhash64("path")).write.parquet(path)
    todo = spark.read.parquet(path)
    count, size = todo.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    if not count:
        return []
    retired = [row[0] for row in todo.where(F.col(INGEST_BATCH).isNotNull()).select(INGEST_BATCH).distinct().collect()]
    pieces = max(-(-count // max_files), -(-size // max_bytes))
    attempt, added = uuid.uuid4().hex[:12], []
    for piece in range(pieces):
        mine = todo.where(F.expr(f"pmod(deal, {pieces}) = {piece}"))
        paths = [row.path for row in mine.select("path").orderBy("path").collect()]
        if paths:
            batch = f"{TAG}{before.run + 1:06d}-{attempt}-{piece:05d}"
            _ingest_batch(spark, lake, paths, batch)
            layers.write_ingest_batch(mine.select("path", "length", "modified_at"), lake.ledger, batch, replace=False)
            added.append(batch)
        if lease is not None:
            lease.renew(spark)
    add_run(spark, lake, before, added, retired, "ingest", lease)
    return added


def _ingest_batch(spark: SparkSession, lake: Lake, paths: list[str], batch: str) -> None:
    """Trips, rejects, cells and counts of a batch; all carry its tag and none is visible yet."""
    raw = raw_files.read_raw(spark, [raw_files.literal_path(path) for path in paths])
    judged = ingest.judged_trips(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = ingest._statistics(judged)
        if found["rows_kept"]:
            kept = trips.finished_trips(judged.filter("is_kept"))
            layers.write_ingest_batch(kept, lake.processed, batch, DAY_KEYS, replace=False)
            # From the stored trips, whose files hold a day each: a task then sums few cells, and what it shuffles
            # grows with the cells and not with the trips, as it does where each task holds trips of all days.
            stored = layers.read_batch(spark, lake.processed, batch, found["months"])
            layers.write_ingest_batch(curated.cells(stored), lake.cells, batch, MONTH_KEYS, replace=False)
        if found["rows_rejected"]:
            rejects = judged.filter("NOT is_kept").withColumn("broken_rules", quality.broken_rules())
            layers.write_ingest_batch(rejects.drop("is_kept"), lake.rejects, batch, replace=False)
    finally:
        judged.unpersist()
    ingest._write_audit(spark, lake, batch, len(paths), found)


def add_run(
    spark: SparkSession,
    lake: Lake,
    before: State,
    added: list[str],
    retired: list[str],
    reason: str,
    lease: Lease | None,
    **more: list[str],
) -> int:
    """Make a new set of batches the visible one, as the record of the next run."""
    if lease is not None:
        lease.check(spark)
    gone = set(retired)
    record = {
        **more, "reason": reason, "added": added, "retired": sorted(gone),
        "visible": [*(b for b in before.batches if b not in gone), *added],
    }
    number = journal.append(spark, lake.runs, record, before.run)
    if number is None:
        raise RunLost(f"run {before.run + 1} is another writer's")
    return number


def rewind(spark: SparkSession, lake: Lake, run: int, lease: Lease | None = None) -> list[str]:
    """Make the lake what it was after ``run`` (0: before the first) and return the batches retired by that.

    What ran since is retired, and batches that later runs replaced are visible again: nothing is read. The files of
    retired batches are new, or changed, for the next ingest."""
    before = state(spark, lake)
    if not 0 <= run <= before.run:
        raise ValueError(f"there is no run {run}; the newest is {before.run}")
    record = journal.read(spark, lake.runs, run) if run else {"visible": []}
    wanted = record["visible"]
    missing = set(wanted) - set(before.batches)
    if missing & _removed(spark, lake):
        raise ValueError(f"run {run} needs batches that were removed")
    retired = sorted(set(before.batches) - set(wanted))
    add_run(
        spark, lake, State(before.run, tuple(b for b in before.batches if b in wanted)),
        sorted(missing), retired, f"rewind to {run}", lease,
    )
    return retired


def _removed(spark: SparkSession, lake: Lake) -> set[str]:
    return {b for record in journal.newest_first(spark, lake.runs) for b in record.get("removed", ())}


def remove_invisible(spark: SparkSession, lake: Lake, keep: int = 2, lease: Lease | None = None) -> list[str]:
    """Delete batches that none of the newest ``keep`` runs shows, such as those of crashed runs; call it under the
    lease. Runs before these can then not be rewound to where they need a deleted batch."""
    before = state(spark, lake)
    needed: set[str] = set()
    for i, record in enumerate(journal.newest_first(spark, lake.runs)):
        if i == keep:
            break
        needed |= set(record["visible"])
    levels = {lake.processed: len(DAY_KEYS), lake.cells: len(MONTH_KEYS), lake.rejects: 0, lake.ledger: 0}
    removed: set[str] = set()
    if lease is not None:
        lease.check(spark)
    for root, depth in levels.items():
        for path in journal.matching(spark, f"{root}{'/*' * depth}/{INGEST_BATCH}={TAG}*"):
            batch = path.rpartition("=")[2]
            if batch not in needed:
                journal.delete(spark, path)
                removed.add(batch)
    if removed:
        add_run(spark, lake, before, [], [], "removal", lease, removed=sorted(removed))
    return sorted(removed)


def runs(spark: SparkSession, lake: Lake) -> DataFrame:
    """(number, reason, added, retired, visible), a row a run."""
    schema = "number BIGINT, reason STRING, added ARRAY<STRING>, retired ARRAY<STRING>, visible ARRAY<STRING>"
    return journal.table(spark, lake.runs, schema)
