"""Incremental ingest: each raw file is read once, and each attempt at a batch gives the same rows.

The stream carries the names of new files and not their rows. Its checkpoint is the bookmark. Each
micro-batch is then an ordinary batch job over the named files, with column pruning, several file
formats and adaptive execution. A batch tag, made of the stream's lasting id and the batch number,
is the last partition column of everything written. A batch leaves a mark before it writes: with no
mark it appends, and a batch that is run again after a crash replaces its own files.
"""

from __future__ import annotations

import threading

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import quality, trips
from meterline.sources import layers, raw_files
from meterline.sources.layers import Lake
from meterline.sources.schemas import DAY_KEYS

MAX_BYTES_PER_BATCH = 256 << 30
MAX_FILES_PER_BATCH = 10_000


def judged_trips(raw: DataFrame) -> DataFrame:
    """Typed trips with a verdict; rejected rows alone have the raw record, as JSON text, and its file."""
    raw_record = trips.raw_row(raw.drop(raw_files.SOURCE_FILE))
    typed = trips.typed_trips(raw, raw_record, raw_files.SOURCE_FILE)
    judged = typed.withColumn("is_kept", quality.all_met())
    only_rejected = {
        "raw_record": F.when(~F.col("is_kept"), F.to_json("raw_record")),
        raw_files.SOURCE_FILE: F.when(~F.col("is_kept"), F.col(raw_files.SOURCE_FILE)),
    }
    return judged.withColumns(only_rejected)


def _statistics(judged: DataFrame) -> dict[str, int | list[int]]:
    """Counts, and the months of kept trips as yyyymm; a handful."""
    pickup = F.col("pickup_datetime")
    month = F.year(pickup) * 100 + F.month(pickup)
    row = judged.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if("is_kept").alias("rows_kept"),
        F.count_if(~F.col("is_kept")).alias("rows_rejected"),
        F.sort_array(F.collect_set(F.when(F.col("is_kept"), month))).alias("months"),
    ).first()
    return row.asDict()


def ingest_files(
    spark: SparkSession, lake: Lake, paths: list[str], batch: str
) -> dict[str, int | list[int]]:
    """Process the named files as one batch and return its statistics."""
    raw = raw_files.read_raw(spark, [raw_files.literal_path(path) for path in paths])
    # Parsed once for counts, trips and rejects. A batch is bounded in bytes and in files, and blocks
    # lost with an executor are parsed again.
    judged = judged_trips(raw).persist(StorageLevel.MEMORY_AND_DISK)
    again = _tried_before(spark, lake, batch)
    try:
        found = _statistics(judged)
        if found["rows_kept"]:
            kept = trips.finished_trips(judged.filter("is_kept"))
            layers.write_ingest_batch(kept, lake.processed, batch, DAY_KEYS, again)
        if found["rows_rejected"]:
            rejects = judged.filter("NOT is_kept").withColumn(
                "broken_rules", quality.broken_rules()
            )
            layers.write_ingest_batch(rejects.drop("is_kept"), lake.rejects, batch, replace=again)
    finally:
        judged.unpersist()
    _write_audit(spark, lake, batch, len(paths), found)
    return found


def _tried_before(spark: SparkSession, lake: Lake, batch: str) -> bool:
    """Leave a mark before the first row of a batch is written, and tell if there was one."""
    marked = f"{lake.attempts}/{layers.INGEST_BATCH}={batch}"
    if layers.if_present(lambda: layers.read_batches(spark, marked)) is not None:
        return True
    mark = spark.range(1).select(F.current_timestamp().alias("started_at"))
    layers.write_ingest_batch(mark, lake.attempts, batch)
    return False


def _write_audit(
    spark: SparkSession, lake: Lake, batch: str, files: int, found: dict[str, int | list[int]]
) -> None:
    kinds = {name: "array<int>" if isinstance(value, list) else "bigint" for name, value in found.items()}
    entry = spark.range(1).select(
        F.lit(files).cast("bigint").alias("files"),
        *[F.lit(value).cast(kinds[name]).alias(name) for name, value in found.items()],
        F.current_timestamp().alias("finished_at"),
    )
    layers.write_ingest_batch(entry, lake.audit, batch)


def ingest_new_files(
    spark: SparkSession,
    lake: Lake,
    max_files: int = MAX_FILES_PER_BATCH,
    max_bytes: int = MAX_BYTES_PER_BATCH,
) -> list[str]:
    """Process every raw file that has not been read yet; return the tags of the batches.

    A micro-batch takes files of ``max_bytes`` in all and is cut into batches of ``max_files``, in the
    order of names, so a replay cuts it alike. A file rewritten under the same name is not read again.
    """
    started, stream_id, done = threading.Event(), [], []

    def run_batch(notices: DataFrame, number: int) -> None:
        paths = sorted(row.path for row in notices.collect())  # names only, of one micro-batch
        started.wait()
        for at in range(0, len(paths), max_files):
            batch = f"{stream_id[0]}-{number}" + (f"-{at // max_files}" if at else "")
            ingest_files(spark, lake, paths[at : at + max_files], batch)
            done.append(batch)

    query = (
        raw_files.new_file_stream(spark, lake.raw, max_bytes)
        .writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", lake.bookmark)
        .trigger(availableNow=True)
        .start()
    )
    # The id is kept in the checkpoint, so it is the same after a restart and new for a new bookmark.
    stream_id.append(query.id)
    started.set()
    query.awaitTermination()
    return done
