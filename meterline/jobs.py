"""Jobs that a scheduler can start: ``python -m meterline.jobs <job> --lake <root> --raw <folder>``."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from meterline.operators import compaction, profile
from meterline.plans import incremental, publish, refresh
from meterline.session import build_session
from meterline.sources import layers, lease
from meterline.sources.layers import Lake
from meterline.streaming import ingest, ledger, merging


def _ingest(spark: SparkSession, lake: Lake, chosen: argparse.Namespace) -> str:
    return f"batches ingested: {len(ingest.ingest_new_files(spark, lake))}"


def _rebuild(spark: SparkSession, lake: Lake, chosen: argparse.Namespace) -> str:
    return "curated tables rebuilt" if refresh.rebuild_curated(spark, lake) else "no trips, nothing written"


def _refresh(spark: SparkSession, lake: Lake, chosen: argparse.Namespace) -> str:
    return f"batches ingested: {len(refresh.refresh(spark, lake, chosen.only_new_months))}"


def _compact(spark: SparkSession, lake: Lake, chosen: argparse.Namespace) -> str:
    rows = compaction.compact_trips(spark, lake.processed, chosen.target, chosen.where)
    return f"rows copied: {rows}"


def _profile(spark: SparkSession, lake: Lake, chosen: argparse.Namespace) -> str:
    trips = layers.read_processed(spark, lake.processed)
    profile.column_profile(trips, approximate=not chosen.exact).write.mode("overwrite").parquet(chosen.target)
    return f"profile written to {chosen.target}"


def _update(spark: SparkSession, lake: Lake, chosen: argparse.Namespace) -> str:
    batches = incremental.update(spark, lake)
    return "another writer is active" if batches is None else f"batches ingested: {len(batches)}"


def _rewind(spark: SparkSession, lake: Lake, chosen: argparse.Namespace) -> str:
    retired = incremental.rewind(spark, lake, chosen.run)
    return "another writer is active" if retired is None else f"batches retired: {len(retired)}"


def _merge(spark: SparkSession, lake: Lake, chosen: argparse.Namespace) -> str:
    batches = merging.compact(spark, lake)
    return "another writer is active" if batches is None else f"batches merged into: {len(batches)}"


def _clean(spark: SparkSession, lake: Lake, chosen: argparse.Namespace) -> str:
    with lease.held(spark, lake) as held:
        if held is None:
            return "another writer is active"
        batches = ledger.remove_invisible(spark, lake, chosen.keep, held)
        versions = publish.remove_old(spark, lake, chosen.keep)
    return f"removed: {len(batches)} batches, {len(versions)} versions"


JOBS: dict[str, Callable[[SparkSession, Lake, argparse.Namespace], str]] = {
    "ingest": _ingest,
    "rebuild": _rebuild,
    "refresh": _refresh,
    "compact": _compact,
    "profile": _profile,
    "update": _update,
    "rewind": _rewind,
    "merge": _merge,
    "clean": _clean,
}


def arguments(given: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="meterline.jobs", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in JOBS:
        job = jobs.add_parser(name)
        job.add_argument("--lake", required=True, help="root folder of the lake")
        if name in ("ingest", "refresh", "update"):
            job.add_argument("--raw", required=True, help="folder of raw files")
        if name == "refresh":
            job.add_argument("--only-new-months", action="store_true", help="rebuild the months of new files only")
        if name in ("compact", "profile"):
            job.add_argument("--target", required=True, help="folder to write")
        if name == "compact":
            job.add_argument("--where", default="true", help="partitions to copy, as a SQL condition")
        if name == "rewind":
            job.add_argument("--run", type=int, required=True, help="run to go back to; 0 is before the first")
        if name == "clean":
            job.add_argument("--keep", type=int, default=2, help="runs and publications whose files stay")
        if name == "profile":
            job.add_argument("--exact", action="store_true", help="count distinct values exactly instead of by sketches")
    return parser.parse_args(given)


def run(spark: SparkSession, chosen: argparse.Namespace) -> str:
    return JOBS[chosen.job](spark, Lake(chosen.lake, raw=getattr(chosen, "raw", "")), chosen)


if __name__ == "__main__":
    chosen = arguments()
    print(run(build_session(f"meterline-{chosen.job}"), chosen))
