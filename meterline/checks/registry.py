"""Every registered query as a function of the session and a folder of driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators import lifecycle, profile, quality, sketches, trips
from meterline.plans import codecs, curated, incremental, refresh, reports, retention
from meterline.plans.lineitem_trips import raw_trips
from meterline.session import new_shared_path
from meterline.sources import catalog, journal, layers, lease, projection, raw_files, schema_log
from meterline.sources.schemas import RAW_TABLE, RAW_USED
from meterline.streaming import ingest, ledger, merging

AS_OF = "2025-07-01"
Query = Callable[[SparkSession, str], DataFrame]


def _over_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(raw_trips(spark, folder))


def _over_typed(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_raw(lambda raw: build(trips.typed_trips(raw)))


def _over_trips(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_raw(lambda raw: build(trips.processed_trips(raw)))


def _over_table(table: curated.CuratedTable, build: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_trips(lambda frame: build(curated.from_trips(table, frame)))


def _from_cells(table: curated.CuratedTable) -> Query:
    return _over_trips(lambda frame: curated.from_cells(table, curated.cells(frame)))


def _quality_rejects(raw: DataFrame) -> DataFrame:
    shown = {
        "tpep_pickup_datetime": "tpep_pickup_datetime",
        "tpep_dropoff_datetime": "tpep_dropoff_datetime",
        "passenger_count": "raw_passengers",
        "trip_distance": "raw_distance",
        "fare_amount": "raw_fare",
        "tip_amount": "raw_tip",
        "total_amount": "raw_total",
        "payment_type": "raw_payment",
    }
    originals = [F.col(source).alias(name) for source, name in shown.items()]
    rejects = quality.rejected(trips.typed_trips(raw, *originals))
    return rejects.select(*shown.values(), F.concat_ws(",", "broken_rules").alias("broken_rules"))


def _sketched_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The exact part of a profile of eight weeks, from the stored sketches of all trips."""
    path = new_shared_path(spark, "column-sketches")
    sketches.store(trips.processed_trips(raw_trips(spark, folder)), trips.TYPED_COLUMNS, path, "all")
    found = sketches.stored_profile(spark, path, trips.TYPED_COLUMNS, "2024-01-10", "2024-03-05")
    return found.select("column_name", "row_count", "null_count", "min_value", "max_value")


def _after_retention(spark: SparkSession, folder: str) -> DataFrame:
    """Trips and days of each month that are left when expired days have been planned and removed."""
    root = new_shared_path(spark, "retention")
    lake = layers.Lake(root, raw=f"{root}/raw")
    layers.append_processed(trips.processed_trips(raw_trips(spark, folder)), lake.processed)
    path = new_shared_path(spark, "retention-plan")
    retention.plan(spark, lake, AS_OF).write.parquet(path)
    retention.apply(spark, lake, spark.read.parquet(path), AS_OF)
    left = layers.read_processed(spark, lake.processed)
    return left.groupBy("year", "month").agg(F.count(F.lit(1)).alias("trips"), F.count_distinct("day").alias("days"))


def _raw_as_csv(spark: SparkSession, folder: str) -> str:
    """The raw trips as CSV files in the shared folder, as they would arrive."""
    path = new_shared_path(spark, "raw-trips")
    raw_trips(spark, folder).write.option("header", True).csv(path)
    return path


def _raw_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    return raw_files.read_raw(spark, _raw_as_csv(spark, folder)).select("VendorID", *RAW_USED)


def _raw_stored_as(kind: str) -> Query:
    """The raw trips through files of another format that raw data is published in."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = new_shared_path(spark, f"raw-{kind}")
        raw_trips(spark, folder).write.format(kind).save(path)
        return raw_files.read_raw(spark, path).select("VendorID", *RAW_USED)

    return run


def _processed_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "processed-trips")
    layers.append_processed(trips.processed_trips(raw_trips(spark, folder)), path)
    return layers.read_processed(spark, path)


def _projected_days(spark: SparkSession, folder: str) -> DataFrame:
    """Trips of eight weeks, whose folders are looked up by name."""
    root = new_shared_path(spark, "projected")
    lake = layers.Lake(root, raw=f"{root}/raw")
    layers.append_processed(trips.processed_trips(raw_trips(spark, folder)), lake.processed)
    return projection.read_days(spark, lake, "2024-01-10", "2024-03-05")


def _schema_versions(spark: SparkSession, folder: str) -> DataFrame:
    """All trips under the newest version, from three batches with other types and columns."""
    root = new_shared_path(spark, "schema-versions")
    stored = trips.processed_trips(raw_trips(spark, folder))
    passengers, payment = F.col("passenger_count"), F.col("payment_type")
    common = ["pickup_datetime", "total_amount"]
    first = stored.where(payment < 3).select(*common, passengers.cast("int"))
    second = stored.where(payment == 3).select(passengers.cast("bigint"), *common, payment)
    third = stored.where(payment > 3).select(*common, passengers.cast("double"), payment.cast("bigint"))
    for number, frame in enumerate((first, second, third)):
        schema_log.append(spark, root, frame, f"batch-{number}")
    return schema_log.read(spark, root).drop(layers.INGEST_BATCH)


def _codec_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each copy, and whether it is smaller than one without compression."""
    stored = trips.processed_trips(raw_trips(spark, folder))
    sizes = codecs.codec_sizes(spark, stored, new_shared_path(spark, "codecs"))
    return sizes.select("codec", "rows", (F.col("share_of_plain") < 1).alias("smaller"))


def _nested_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Raw CSV files in folders of any depth, beside files of a kind that is not read."""
    root, raw = new_shared_path(spark, "nested"), raw_trips(spark, folder)
    early = F.coalesce(F.col("payment_type").cast("int") < 3, F.lit(False))
    raw.where(early).write.option("header", True).csv(f"{root}/2024/a")
    raw.where(~early).write.option("header", True).csv(f"{root}/b/c/d")
    notes = raw.select(F.to_json(F.struct("*")).alias("value"))  # four times the bytes of the CSV files if not compressed
    notes.write.option("compression", "lz4").text(f"{root}/b/notes")
    return raw_files.read_raw(spark, root).select("VendorID", *RAW_USED)


def _catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Trips of each month by SQL over two tables of the catalog: raw CSV files, and a curated table with its partitions
    repaired. The database is made for this and dropped."""
    raw, database = raw_trips(spark, folder), f"check_{uuid.uuid4().hex}"
    csv, daily = new_shared_path(spark, "raw-table"), new_shared_path(spark, "daily-table")
    fields = T.StructType.fromDDL(RAW_TABLE)
    columns = [F.col(f.name) if f.name in raw.columns else F.lit(None).cast("string").alias(f.name) for f in fields]
    raw.select(*columns).write.option("header", True).csv(csv)
    layers.write_curated(curated.from_trips(curated.DAILY, trips.processed_trips(raw)), daily)
    table = curated.DAILY.catalog_name
    spark.sql(f"CREATE DATABASE {database}")
    try:
        spark.sql(catalog.raw_table_ddl(database, csv))
        spark.sql(catalog.parquet_table_ddl(database, table, daily))
        spark.sql(f"MSCK REPAIR TABLE {database}.{table}")
        found = spark.sql(
            f"""SELECT year, month, SUM(total_trips) AS trips, COUNT(*) AS days,
            (SELECT COUNT(*) FROM {database}.{catalog.RAW_NAME}) AS raw_rows
            FROM {database}.{table} GROUP BY year, month"""
        )
        return found.checkpoint()
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def _incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    lake = layers.Lake(new_shared_path(spark, "lake"), raw=_raw_as_csv(spark, folder))
    ingest.ingest_new_files(spark, lake)
    return layers.read_processed(spark, lake.processed)


def _stored(table: curated.CuratedTable, build: Callable[[DataFrame], DataFrame]) -> Query:
    """A report as users run it: raw CSV files, a refresh, and the stored curated table. Each call makes its own lake, so
    that its cost is that of the tables and not of what the session ran before."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        lake = layers.Lake(new_shared_path(spark, "refreshed"), raw=_raw_as_csv(spark, folder))
        refresh.refresh(spark, lake)
        return build(layers.read_curated(spark, lake, table.name))

    return run


def _lease_log(spark: SparkSession, folder: str) -> DataFrame:
    """Who wrote to a lake: a holder in whose time another update is skipped, one that died, and one that takes over."""
    lake = layers.Lake(new_shared_path(spark, "lake"), raw=_raw_as_csv(spark, folder))
    with lease.held(spark, lake, "first"):
        if incremental.update(spark, lake, "skipped") is not None:
            raise RuntimeError("two writers at once")
    lease.take(spark, lake, "stuck", seconds=0)
    incremental.update(spark, lake, "update")
    read = layers.read_batches(spark, lake.audit).agg(F.sum("rows_read").alias("rows_read"))
    log = lease.log(spark, lake).select("number", "holder", F.col("released_at").isNotNull().alias("released"))
    counted = log.join(read.withColumn("holder", F.lit("update")), "holder", "left")
    return counted.withColumn("rows_read", F.coalesce("rows_read", F.lit(0).cast("bigint")))


def _rewritten_lake(spark: SparkSession, folder: str) -> layers.Lake:
    """A lake with two folders of files, of which the second is rewritten, under the same names, with the trips of one
    payment type only; updated before and after."""
    lake = layers.Lake(new_shared_path(spark, "lake"), raw=new_shared_path(spark, "raw"))
    raw, late = raw_trips(spark, folder), new_shared_path(spark, "rewritten")
    payment = F.col("payment_type").cast("int")
    raw.where(payment < 3).write.option("header", True).csv(f"{lake.raw}/first")
    raw.where(payment >= 3).write.option("header", True).csv(f"{lake.raw}/second")
    incremental.update(spark, lake)
    raw.where(payment == 3).write.option("header", True).csv(late)
    old, new = ([p for p in journal.matching(spark, f"{f}/part-*")] for f in (f"{lake.raw}/second", late))
    for path in old:
        journal.delete(spark, path)
    for was, path in zip(old, new, strict=True):
        journal.rename(spark, path, was)
    incremental.update(spark, lake)
    return lake


def _incremental_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The four published tables as one, after files were rewritten; columns that a table lacks are null."""
    lake = _rewritten_lake(spark, folder)
    tables = [
        layers.read_curated(spark, lake, table.name).withColumn("table_name", F.lit(table.name)) for table in curated.TABLES
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _file_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a lake in which a folder was rewritten, by run and status, with the trips their batches kept."""
    lake = _rewritten_lake(spark, folder)
    run = F.regexp_extract(layers.INGEST_BATCH, "run-([0-9]+)", 1).cast("int").alias("run")
    files = ledger.files(spark, lake)
    batches = files.groupBy(layers.INGEST_BATCH, "status").agg(F.count("*").alias("n"))
    audit = layers.read_batches(spark, lake.audit).select(layers.INGEST_BATCH, "rows_read", "rows_kept")
    counted = batches.where("n > 0").join(audit, layers.INGEST_BATCH)
    return counted.groupBy(run, "status").agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_kept").alias("rows_kept"))


def _bookmark_rewind(spark: SparkSession, folder: str) -> DataFrame:
    """Trips and days after two runs, after going back to the first, and after the next update."""
    lake = layers.Lake(new_shared_path(spark, "lake"), raw=new_shared_path(spark, "raw"))
    raw, payment = raw_trips(spark, folder), F.col("payment_type").cast("int")
    raw.where(payment < 3).write.option("header", True).csv(f"{lake.raw}/first")
    incremental.update(spark, lake)
    raw.where(payment >= 3).write.option("header", True).csv(f"{lake.raw}/second")
    incremental.update(spark, lake)

    def days(state: str) -> DataFrame:
        daily = layers.read_curated(spark, lake, "daily_trip_statistics")
        return daily.agg(F.sum("total_trips").alias("trips"), F.count("*").alias("days")).withColumn("state", F.lit(state))

    both = days("both runs")
    incremental.rewind(spark, lake, 1)
    back = days("rewound")
    incremental.update(spark, lake)
    return both.unionByName(back).unionByName(days("updated"))


def _compacted_lake(spark: SparkSession, folder: str) -> DataFrame:
    """Trips, days and batches of a lake before its batches are merged in place, after it, and after going back."""
    lake = layers.Lake(new_shared_path(spark, "lake"), raw=new_shared_path(spark, "raw"))
    raw, payment = raw_trips(spark, folder), F.col("payment_type").cast("int")
    for name, some in {"first": payment < 3, "second": payment >= 3}.items():
        raw.where(some).write.option("header", True).csv(f"{lake.raw}/{name}")
        incremental.update(spark, lake)

    def found(state: str) -> DataFrame:
        day = F.make_date("year", "month", "day")
        visible = ledger.read_visible(spark, lake).agg(F.count("*").alias("trips"), F.count_distinct(day).alias("days"))
        daily = layers.read_curated(spark, lake, "daily_trip_statistics").agg(F.sum("total_trips").alias("daily_trips"))
        batches = len(ledger.state(spark, lake).batches)
        return visible.join(daily).withColumns({"state": F.lit(state), "batches": F.lit(batches)})

    before = found("two batches")
    merging.compact(spark, lake)
    merged = found("merged")
    incremental.rewind(spark, lake, 2)
    return before.unionByName(merged).unionByName(found("rewound"))


def _metrics(frame: DataFrame) -> DataFrame:
    return frame.select(
        "pickup_datetime",
        "dropoff_datetime",
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "total_amount",
        "trip_duration_minutes",
        "avg_speed_mph",
        "tip_percentage",
    )


def _time_dimensions(frame: DataFrame) -> DataFrame:
    return trips.with_time_dimensions(frame).select(
        "pickup_datetime",
        "dropoff_datetime",
        "total_amount",
        "pickup_hour",
        "pickup_day_of_week",
        "pickup_date",
    )


def _with_dates_as_text(build: Query) -> Query:
    """DATE columns as ISO text: the client libraries of the two engines return a DATE differently."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        frame = build(spark, folder)
        dates = [field.name for field in frame.schema if isinstance(field.dataType, T.DateType)]
        return frame.withColumns({name: F.col(name).cast("string") for name in dates})

    return run


def registered() -> dict[str, Query]:
    return {name: _with_dates_as_text(build) for name, build in _queries().items()}


def _queries() -> dict[str, Query]:
    daily, hourly, payment, distance = curated.TABLES
    return {
        "raw_scan": raw_trips,
        "raw_csv_scan": _raw_csv_scan,
        "raw_json_scan": _raw_stored_as("json"),
        "raw_parquet_scan": _raw_stored_as("parquet"),
        "typed_trips": _over_typed(lambda typed: typed),
        "quality_filter": _over_typed(quality.kept),
        "derived_metrics": _over_trips(_metrics),
        "processed_trips": _over_trips(lambda frame: frame),
        "processed_scan": _processed_scan,
        "projected_days": _projected_days,
        "schema_versions": _schema_versions,
        "codec_sizes": _codec_sizes,
        "nested_scan": _nested_scan,
        "catalog_tables": _catalog_tables,
        "compacted_lake": _compacted_lake,
        "incremental_ingest": _incremental_ingest,
        "lease_log": _lease_log,
        "file_ledger": _file_ledger,
        "bookmark_rewind": _bookmark_rewind,
        "incremental_tables": _incremental_tables,
        "time_dimensions": _over_trips(_time_dimensions),
        "daily_trip_statistics": _over_table(daily, lambda table: table),
        "hourly_trip_patterns": _over_table(hourly, lambda table: table),
        "payment_type_analysis": _over_table(payment, lambda table: table),
        "distance_distribution": _over_table(distance, lambda table: table),
        "curated_daily_from_cells": _from_cells(daily),
        "curated_hourly_from_cells": _from_cells(hourly),
        "curated_payment_from_cells": _from_cells(payment),
        "curated_distance_from_cells": _from_cells(distance),
        "daily_revenue_trends": _over_table(daily, reports.daily_revenue_trends),
        "daily_revenue_trends_10": _over_table(
            daily, lambda table: reports.daily_revenue_trends(table, days=10)
        ),
        "top_revenue_days": _over_table(daily, reports.top_revenue_days),
        "kpi_totals": _over_table(daily, reports.kpi_totals),
        "monthly_revenue_summary": _over_table(daily, reports.monthly_revenue_summary),
        "peak_hours": _over_table(hourly, reports.peak_hours),
        "peak_hours_10": _over_table(
            hourly, lambda table: reports.peak_hours(table, rows=10)
        ),
        "weekend_vs_weekday": _over_table(hourly, reports.weekend_vs_weekday),
        "metrics_by_day_of_week": _over_table(hourly, reports.metrics_by_day_of_week),
        "payment_preferences": _over_table(payment, reports.payment_preferences),
        "distance_distribution_report": _over_table(
            distance, reports.distance_distribution_report
        ),
        "stored_daily_revenue_trends": _stored(daily, reports.daily_revenue_trends),
        "stored_monthly_revenue_summary": _stored(daily, reports.monthly_revenue_summary),
        "stored_peak_hours": _stored(hourly, reports.peak_hours),
        "stored_weekend_vs_weekday": _stored(hourly, reports.weekend_vs_weekday),
        "stored_payment_preferences": _stored(payment, reports.payment_preferences),
        "stored_distance_distribution_report": _stored(distance, reports.distance_distribution_report),
        "high_value_trips": _over_trips(reports.high_value_trips),
        "tip_by_trip_category": _over_trips(reports.tip_by_trip_category),
        "data_quality_check": _over_trips(reports.data_quality_check),
        "data_quality_global": _over_trips(reports.data_quality_global),
        "storage_estimate": _over_trips(reports.storage_estimate),
        "benchmark_partition_agg": _over_trips(reports.benchmark_partition_agg),
        "count_month": _over_trips(lambda frame: reports.count_trips(frame, 2024, 1)),
        "count_day": _over_trips(lambda frame: reports.count_trips(frame, 2024, 1, 15)),
        "partition_distribution": _over_trips(reports.partition_distribution),
        "partition_filter": _over_trips(
            lambda frame: reports.in_partition(frame, 2024, 1, 15)
        ),
        "timestamp_range_filter": _over_trips(
            lambda frame: reports.picked_up_after(frame, "2024-01-15")
        ),
        "quality_rejects": _over_raw(_quality_rejects),
        "reject_counts": _over_typed(quality.reject_counts),
        "job_statistics": _over_typed(quality.statistics),
        "column_profile": _over_typed(
            lambda typed: profile.column_profile(typed, trips.TYPED_COLUMNS)
        ),
        "after_retention": _after_retention,
        "sketched_profile": _sketched_profile,
        "partition_age_tiers": _over_trips(
            lambda frame: lifecycle.age_tiers(lifecycle.partitions_of(frame), AS_OF)
        ),
        "expired_partitions": _over_trips(
            lambda frame: lifecycle.expired(lifecycle.partitions_of(frame), AS_OF)
        ),
    }
