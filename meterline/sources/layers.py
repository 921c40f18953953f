"""Where the layers lie and how they are written."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sources import journal
from meterline.sources.schemas import DAY_KEYS, MONTH_KEYS, PROCESSED_COLUMNS, read_schema

INGEST_BATCH = "ingest_batch"


@dataclass(frozen=True)
class Lake:
    """Folders of one lake. A bookmark is reset by starting again with a new root: files are read
    from the beginning and nothing written before is duplicated."""

    root: str
    raw: str

    @property
    def processed(self) -> str:
        return f"{self.root}/processed/taxi_trips"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects/taxi_trips"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit/ingest"

    @property
    def attempts(self) -> str:
        return f"{self.root}/bookmarks/attempts"

    @property
    def rebuilt(self) -> str:
        return f"{self.root}/audit/rebuilt"

    @property
    def bookmark(self) -> str:
        return f"{self.root}/bookmarks/raw"

    def curated(self, table: str) -> str:
        return f"{self.root}/curated/{table}"

    def version(self, version: str, table: str) -> str:
        """A table of one published version of the four."""
        return f"{self.versions}/{version}/{table}"

    @property
    def versions(self) -> str:
        return f"{self.root}/versions"

    @property
    def published(self) -> str:
        return f"{self.root}/bookmarks/published"

    @property
    def leases(self) -> str:
        return f"{self.root}/bookmarks/leases"

    @property
    def ledger(self) -> str:
        return f"{self.root}/bookmarks/ledger"

    @property
    def runs(self) -> str:
        return f"{self.root}/bookmarks/runs"

    @property
    def cells(self) -> str:
        return f"{self.root}/cells/taxi_trips"


# Below 2000, from which on Spark keeps only average sizes and could not see a hot day.
FIRST_PARTITIONS = 1024


def by_partition(frame: DataFrame, *keys: str) -> DataFrame:
    """Shuffle rows of a partition together, so that each makes few files. Adaptive execution splits
    a partition above the advisory size, so a hot day is written by many tasks, and merges small ones. There are
    more partitions than days of several years at first, so that days seldom share one and each makes few files."""
    return frame.hint("rebalance", FIRST_PARTITIONS, *[F.col(key) for key in keys])


def append_processed(trips: DataFrame, path: str, compression: str = "snappy") -> None:
    """Append trips as a batch of their own, in the partition levels that incremental ingest writes."""
    tagged = by_partition(trips, *DAY_KEYS).withColumn(INGEST_BATCH, F.lit(f"load-{uuid.uuid4().hex}"))
    writer = tagged.write.mode("append").partitionBy(*DAY_KEYS, INGEST_BATCH)
    writer.option("compression", compression).parquet(path)


def write_ingest_batch(
    frame: DataFrame, path: str, batch: str, keys: tuple[str, ...] = (), replace: bool = True
) -> None:
    """Write one batch into partitions of its own. With ``replace``, a second attempt takes the place
    of whatever the first one wrote; a first attempt can append, which commits faster."""
    tagged = (by_partition(frame, *keys) if keys else frame).withColumn(INGEST_BATCH, F.lit(batch))
    (
        tagged.write.mode("overwrite" if replace else "append")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys, INGEST_BATCH)
        .option("compression", "snappy")
        .parquet(path)
    )


def write_curated(table: DataFrame, path: str, keep_other_months: bool = False) -> None:
    mode = "dynamic" if keep_other_months else "static"
    (
        by_partition(table, *MONTH_KEYS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*MONTH_KEYS)
        .option("compression", "snappy")
        .parquet(path)
    )


def read_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    return spark.read.schema(read_schema(table)).parquet(path)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, "processed_taxi_trips", path).select(*PROCESSED_COLUMNS)


def read_batch(spark: SparkSession, path: str, batch: str, months: Iterable[int]) -> DataFrame:
    """Trips of one batch; of the layer its months (yyyymm) alone are listed."""
    folders = [f"{path}/year={m // 100}/month={m % 100}" for m in months]
    schema = f"{read_schema('processed_taxi_trips')}, {INGEST_BATCH} STRING"
    trips = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return trips.where(F.col(INGEST_BATCH) == batch).select(*PROCESSED_COLUMNS)


def month_name(year: int, month: int) -> str:
    return f"{year:04d}-{month:02d}"


def published_months(spark: SparkSession, lake: Lake) -> dict[str, str] | None:
    """The version that holds each month, as the newest publication has it; None where nothing was published."""
    record = journal.latest(spark, lake.published)
    return record and record["months"]


def published_folders(months: dict[str, str]) -> dict[str, list[str]]:
    """Month folders of each version."""
    found: dict[str, list[str]] = {}
    for name, version in sorted(months.items()):
        year, month = name.split("-")
        found.setdefault(version, []).append(f"year={int(year)}/month={int(month)}")
    return found


def read_curated(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """A curated table of the newest publication: whole months, each from the version that holds it. All four tables
    read with one publication belong together, and later ones do not change a frame. Without publications, the folder
    of the table."""
    name = f"curated_{table}"
    months = published_months(spark, lake)
    if months is None:
        return read_table(spark, name, lake.curated(table))
    frames = []
    for version, folders in published_folders(months).items():
        root = lake.version(version, table)
        reader = spark.read.schema(read_schema(name)).option("basePath", root)
        frames.append(reader.parquet(*[f"{root}/{folder}" for folder in folders]))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], read_schema(name))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """A folder written by ``write_ingest_batch``, with the batch of each row."""
    return spark.read.parquet(path)


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame that ``read`` gives, or None when its folder does not exist yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
