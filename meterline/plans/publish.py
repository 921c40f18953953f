"""Publication of the four curated tables as one set.

Tables are written into the folders of a new version, which no reader knows. One record then names, for each month, the
version that holds it, and becomes the present state by its number. Months that are not written again stay with their
version, so that a publication costs what has changed. A publication that fails leaves nothing visible, and a reader
that has begun goes on with the versions it started from, until ``remove_old`` is called.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from meterline.plans import curated
from meterline.sources import journal, layers
from meterline.sources.layers import Lake
from meterline.sources.lease import Lease


class PublicationLost(RuntimeError):
    """Another writer has published in the meantime."""


def publish(
    spark: SparkSession,
    lake: Lake,
    cells: DataFrame,
    months: Iterable[tuple[int, int]] | None = None,
    batches: Sequence[str] = (),
    lease: Lease | None = None,
) -> int:
    """Publish the months of the cells and return the number of the publication.

    With ``months`` these alone are replaced, and those without cells are dropped; else the set is what the cells
    hold. ``batches`` are noted as what the set covers.
    """
    before = journal.latest(spark, lake.published) or {"number": 0, "months": {}}
    held = dict(before["months"]) if months is not None else {}
    for year, month in months or ():
        held.pop(layers.month_name(year, month), None)
    present = cells.select("year", "month").distinct().collect()
    if present:
        version = uuid.uuid4().hex
        for table in curated.TABLES:
            layers.write_curated(curated.from_cells(table, cells), lake.version(version, table.name))
        held |= {layers.month_name(row.year, row.month): version for row in present}
    if lease is not None:
        lease.check(spark)
    record = {"months": held, "batches": sorted(batches)}
    number = journal.append(spark, lake.published, record, before["number"])
    if number is None:
        raise PublicationLost(f"publication {before['number'] + 1} is another writer's")
    return number


def renamed(spark: SparkSession, lake: Lake, merged: dict[str, list[str]], lease: Lease | None = None) -> int | None:
    """Note that batches were merged into others of the same rows, so that no month is published again for it.

    Left as it is where a merged batch was covered in part only: the next publication then finds what differs."""
    before = journal.latest(spark, lake.published)
    covered = set(before["batches"]) if before else set()
    if any(set(old) & covered and not set(old) <= covered for old in merged.values()):
        return None
    known = {new: old for new, old in merged.items() if set(old) <= covered}
    if not known:
        return None
    if lease is not None:
        lease.check(spark)
    covered -= {name for old in known.values() for name in old}
    record = {"months": before["months"], "batches": sorted(covered | set(known))}
    return journal.append(spark, lake.published, record, before["number"])


def old_versions(spark: SparkSession, lake: Lake, keep: int = 2) -> list[str]:
    """Versions that none of the newest ``keep`` publications needs: replaced ones, and those of failed runs.

    A version that is being written looks the same, so remove them while holding the lease."""
    needed: set[str] = set()
    for i, record in enumerate(journal.newest_first(spark, lake.published)):
        if i == keep:
            break
        needed |= set(record["months"].values())
    return [name for name in journal.names(spark, lake.versions) if name not in needed]


def remove_old(spark: SparkSession, lake: Lake, keep: int = 2) -> list[str]:
    removed = old_versions(spark, lake, keep)
    for version in removed:
        journal.delete(spark, f"{lake.versions}/{version}")
    return removed
