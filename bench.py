"""Times the two layer builds and every report on stored tables; prints one JSON line.

The raw CSV files are made from ``lineitem`` first and are not timed.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from meterline.operators import lifecycle, profile, quality, trips
from meterline.plans import curated, refresh, reports
from meterline.plans.lineitem_trips import raw_trips
from meterline.session import build_session
from meterline.sources import layers, raw_files

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    work = tempfile.mkdtemp(prefix="meterline-bench-")
    spark = build_session(
        "meterline-bench",
        master=f"local[{CPUS}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.checkpoint.dir": f"{work}/checkpoints",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw_files_path = f"{work}/raw"
    raw = raw_trips(spark, FOLDER)
    raw.repartition(int(CPUS)).write.option("header", True).csv(raw_files_path)
    lake = layers.Lake(f"{work}/lake", raw=raw_files_path)
    seconds: dict[str, float] = {}

    def timed(name: str, work_once) -> None:
        start = time.perf_counter()
        work_once()
        seconds[name] = round(time.perf_counter() - start, 3)

    def processed():
        return trips.processed_trips(raw_files.read_raw(spark, lake.raw))

    def flat() -> None:
        processed().write.format("noop").mode("overwrite").save()

    timed("raw_to_processed_transform", flat)
    timed(
        "raw_to_processed_write", lambda: layers.append_processed(processed(), lake.processed)
    )
    timed("processed_to_curated", lambda: refresh.rebuild_curated(spark, lake))

    stored = layers.read_processed(spark, lake.processed)
    daily, hourly, payment, distance = (
        layers.read_curated(spark, lake, table.name) for table in curated.TABLES
    )
    typed = trips.typed_trips(raw_files.read_raw(spark, lake.raw))
    report_frames = {
        "daily_revenue_trends": lambda: reports.daily_revenue_trends(daily),
        "peak_hours": lambda: reports.peak_hours(hourly),
        "weekend_vs_weekday": lambda: reports.weekend_vs_weekday(hourly),
        "payment_preferences": lambda: reports.payment_preferences(payment),
        "distance_distribution_report": lambda: reports.distance_distribution_report(distance),
        "high_value_trips": lambda: reports.high_value_trips(stored),
        "metrics_by_day_of_week": lambda: reports.metrics_by_day_of_week(hourly),
        "tip_by_trip_category": lambda: reports.tip_by_trip_category(stored),
        "monthly_revenue_summary": lambda: reports.monthly_revenue_summary(daily),
        "data_quality_check": lambda: reports.data_quality_check(stored),
        "storage_estimate": lambda: reports.storage_estimate(stored),
        "benchmark_partition_agg": lambda: reports.benchmark_partition_agg(stored),
        "top_revenue_days": lambda: reports.top_revenue_days(daily),
        "kpi_totals": lambda: reports.kpi_totals(daily),
        "timestamp_range_filter": lambda: reports.picked_up_after(stored, "2024-01-15"),
        "reject_counts": lambda: quality.reject_counts(typed),
        "column_profile": lambda: profile.column_profile(typed, trips.TYPED_COLUMNS),
        "partition_age_tiers": lambda: lifecycle.age_tiers(
            lifecycle.partitions_of(stored), "2025-07-01"
        ),
    }
    for name, build in report_frames.items():
        timed(name, lambda: build().write.format("noop").mode("overwrite").save())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "layer builds and reports, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
