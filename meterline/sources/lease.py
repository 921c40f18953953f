"""One writer of a lake at a time.

A lease is a numbered record with its holder and the time at which it ends. Who wants to write reads the newest lease
and, if that is released or over, creates the next number; only one of several writers can. A writer that does not get
it leaves at once, as the files it would have read are found by the next run. The number also fences: a holder whose
lease was taken over, because it was stuck for too long, finds a newer number before it makes anything visible and stops.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sources import journal
from meterline.sources.layers import Lake

SECONDS = 6 * 3600
_LEASE = "number BIGINT, holder STRING, taken_at DOUBLE, ends_at DOUBLE"
_RELEASE = "number BIGINT, released_at DOUBLE"


class LeaseLost(RuntimeError):
    """Another writer has taken over."""


@dataclass
class Lease:
    lake: Lake
    number: int
    holder: str
    seconds: float
    ends_at: float

    def check(self, spark: SparkSession) -> None:
        """To be called right before what was written becomes visible."""
        if journal.numbers(spark, self.lake.leases)[-1] != self.number:
            raise LeaseLost(f"lease {self.number} of {self.holder} was taken over")

    def renew(self, spark: SparkSession) -> None:
        """Take the next number for the same holder once half of the time is over."""
        if time.time() < self.ends_at - self.seconds / 2:
            return
        self.check(spark)
        more = _taken(spark, self.lake, self.holder, self.seconds, self.number)
        if more is None:
            raise LeaseLost(f"lease {self.number} of {self.holder} was taken over")
        self.release(spark)
        self.number, self.ends_at = more.number, more.ends_at

    def release(self, spark: SparkSession) -> None:
        record = {"number": self.number, "released_at": time.time()}
        journal.create(spark, f"{self.lake.leases}/released/{self.number}.json", record)


def _taken(spark: SparkSession, lake: Lake, holder: str, seconds: float, after: int) -> Lease | None:
    now = time.time()
    record = {"holder": holder, "taken_at": now, "ends_at": now + seconds}
    number = journal.append(spark, lake.leases, record, after)
    return number and Lease(lake, number, holder, seconds, now + seconds)


def take(spark: SparkSession, lake: Lake, holder: str = "", seconds: float = SECONDS) -> Lease | None:
    """A lease, or None while another writer holds one."""
    known = journal.numbers(spark, lake.leases)
    last = known[-1] if known else 0
    if last and f"{last}.json" not in journal.names(spark, f"{lake.leases}/released"):
        record = journal.read(spark, lake.leases, last)
        over = journal.abandoned(spark, lake.leases, last) if record is None else record["ends_at"] <= time.time()
        if not over:
            return None
    return _taken(spark, lake, holder or uuid.uuid4().hex, seconds, last)


@contextmanager
def held(spark: SparkSession, lake: Lake, holder: str = "", seconds: float = SECONDS) -> Iterator[Lease | None]:
    """A lease for the time of a block, or None."""
    lease = take(spark, lake, holder, seconds)
    try:
        yield lease
    finally:
        if lease is not None:
            lease.release(spark)


def log(spark: SparkSession, lake: Lake) -> DataFrame:
    """(number, holder, taken_at, ends_at, released_at), a row a lease."""
    released = f"{lake.leases}/released"
    ends = (
        spark.read.schema(_RELEASE).json(f"{released}/*.json")
        if journal.names(spark, released)
        else spark.createDataFrame([], _RELEASE)
    )
    leases = journal.table(spark, lake.leases, _LEASE).join(ends, "number", "left")
    return leases.select(
        "number", "holder", *[F.timestamp_seconds(c).alias(c) for c in ("taken_at", "ends_at", "released_at")]
    )
