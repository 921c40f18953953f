from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from meterline.operators import compaction, lifecycle, profile
from meterline.plans import refresh
from meterline.sources import catalog, layers
from meterline.sources.layers import Lake
from meterline.sources.schemas import PARQUET_TABLES
from tests.test_sources import write
from tests.trip_rows import HEADER, LINE, processed

DATABASE = "lake_db"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("upkeep")
    made = Lake(f"{root}/lake", raw=f"{root}/raw")
    for number in range(4):
        lines = [LINE.replace("2024-01-15", f"2024-01-{day:02d}") for day in (14, 15)]
        write(f"{made.raw}/{number}.csv", HEADER, *lines)
        refresh.refresh(spark, made)
    catalog.create_tables(spark, made, DATABASE)
    catalog.repair_partitions(spark, DATABASE, made)
    yield made
    spark.sql(f"DROP DATABASE {DATABASE} CASCADE")


def test_tables_and_partitions(spark, lake):
    names = {table.name for table in spark.catalog.listTables(DATABASE)}
    assert names == {catalog.RAW_NAME, *PARQUET_TABLES}
    assert spark.table(f"{DATABASE}.processed_taxi_trips").count() == 8
    assert spark.sql(f"SHOW PARTITIONS {DATABASE}.processed_taxi_trips").count() == 8
    daily = spark.table(f"{DATABASE}.curated_daily_trip_statistics").orderBy("day").collect()
    assert [(row.day, row.total_trips, row.total_revenue) for row in daily] == [
        (14, 4, 102.0),
        (15, 4, 102.0),
    ]
    assert catalog.create_tables(spark, lake, DATABASE) is None  # IF NOT EXISTS


def test_raw_table_skips_the_header(spark, tmp_path):
    names = [field.split()[0] for field in catalog.RAW_TABLE.split(",")]
    write(tmp_path / "a.csv", ",".join(names), ",".join(["x"] * 19))
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_db")
    spark.sql(catalog.raw_table_ddl("raw_db", str(tmp_path)))
    (row,) = spark.table(f"raw_db.{catalog.RAW_NAME}").collect()
    assert (row.tpep_pickup_datetime, row.fare_amount) == ("x", None)
    assert len(row) == 19
    spark.sql("DROP DATABASE raw_db CASCADE")


def test_raw_columns_by_name(spark, tmp_path):
    """A file with another column order fails in the table, which goes by position, and is right in the view."""
    write(f"{tmp_path}/deep/a.csv", HEADER, LINE)
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_db")
    spark.sql(catalog.raw_table_ddl("raw_db", str(tmp_path)))
    with pytest.raises(Exception, match="header"):
        spark.table(f"raw_db.{catalog.RAW_NAME}").collect()
    spark.sql("DROP DATABASE raw_db CASCADE")
    catalog.raw_view(spark, Lake(f"{tmp_path}/lake", raw=str(tmp_path)), "raw_by_name")
    (row,) = spark.table("raw_by_name").collect()
    assert (row.tpep_pickup_datetime, row.fare_amount, row.extra) == ("2024-01-15 10:00:00", 25.5, None)
    spark.catalog.dropTempView("raw_by_name")


def test_partition_filter_on_table_prunes(spark, lake):
    frame = spark.table(f"{DATABASE}.processed_taxi_trips").filter("year = 2024 AND day = 15")
    assert frame.count() == 4
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "day=15" in plan or "(day#" in plan.split("PartitionFilters")[1]


def test_statistics(spark, lake):
    table = f"{DATABASE}.curated_payment_type_analysis"
    catalog.compute_statistics(spark, table)
    rows = spark.sql(f"DESCRIBE EXTENDED {table} transaction_count").collect()
    assert {row.info_name: row.info_value for row in rows}["max"] == "8"


def test_sample_is_repeatable(spark, lake):
    table = f"{DATABASE}.processed_taxi_trips"
    first, second = (catalog.sampled(spark, table, 50, seed=3).collect() for _ in range(2))
    assert first == second and len(first) <= 8
    assert catalog.sampled(spark, table, 100, seed=3).count() == 8


def test_found_schemas(spark, lake):
    schemas = {
        "raw": catalog.found_schema(spark, lake.raw, "csv"),
        "processed": catalog.found_schema(spark, lake.processed, "parquet"),
    }
    report = catalog.schema_report(spark, schemas)
    types = {(row.table_name, row.column_name): row.data_type for row in report.collect()}
    assert types["raw", "fare_amount"] == "double"
    assert types["raw", "tpep_pickup_datetime"] == "timestamp"
    assert types["processed", "passenger_count"] == "int"
    assert types["processed", "year"] == "int"


def test_new_columns_are_followed(spark, lake, tmp_path):
    spark.sql(f"CREATE TABLE {DATABASE}.t (a INT, b STRING) USING parquet LOCATION '{tmp_path}/t'")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.mode("append").parquet(f"{tmp_path}/t")
    spark.sql("SELECT 2 AS a, 0.5D AS c").write.mode("append").parquet(f"{tmp_path}/t")
    found = catalog.found_schema(spark, f"{tmp_path}/t", "parquet")
    changes = catalog.follow_schema(spark, f"{DATABASE}.t", found).collect()
    assert [(row.column_name, row.change) for row in changes] == [("c", "added")]
    rows = spark.table(f"{DATABASE}.t").orderBy("a").collect()
    assert [tuple(row) for row in rows] == [(1, "x", None), (2, None, 0.5)]


def test_missing_and_changed_columns_are_only_reported(spark):
    known = T.StructType.fromDDL("a INT, b STRING")
    changes = catalog.schema_changes(spark, known, T.StructType.fromDDL("A DOUBLE")).collect()
    assert {(row.column_name, row.change) for row in changes} == {("a", "changed"), ("b", "missing")}


def test_compaction_merges_files(spark, lake, tmp_path):
    target = f"{tmp_path}/compacted"
    rows = compaction.compact_trips(spark, lake.processed, target, "year = 2024 AND day = 15")
    assert rows == 4
    day = f"{target}/year=2024/month=1/day=15/ingest_batch=compacted"
    assert len([name for name in os.listdir(day) if name.endswith(".parquet")]) == 1
    assert not os.path.exists(f"{target}/year=2024/month=1/day=14")
    assert layers.read_processed(spark, lake.processed).count() == 8


@pytest.mark.parametrize(
    ("age", "raw", "processed_tier", "curated_tier"),
    [
        (29, "standard", "standard", "standard"),
        (30, "infrequent", "standard", "standard"),
        (60, "infrequent", "infrequent", "standard"),
        (90, "archive", "infrequent", "infrequent"),
        (180, "deep_archive", "archive", "infrequent"),
        (-5, "standard", "standard", "standard"),
    ],
)
def test_age_tiers(spark, age, raw, processed_tier, curated_tier):
    days = spark.sql(f"SELECT date_sub(DATE '2024-06-30', {age}) AS d").selectExpr(
        "year(d) AS year", "month(d) AS month", "day(d) AS day"
    )
    tiers = {row.layer: row.tier for row in lifecycle.age_tiers(days, "2024-06-30").collect()}
    assert tiers == {"raw": raw, "processed": processed_tier, "curated": curated_tier}


def test_expired_partitions_from_the_catalog(spark, lake):
    days = lifecycle.partitions_in_catalog(spark, f"{DATABASE}.processed_taxi_trips")
    assert sorted(tuple(row) for row in days.collect()) == [(2024, 1, 14), (2024, 1, 15)]

    def gone(as_of):
        return sorted((row.layer, row.day) for row in lifecycle.expired(days, as_of).collect())

    assert gone("2025-01-13") == []
    assert gone("2025-01-14") == [("raw", 14)]
    assert gone("2026-01-14") == [("processed", 14), ("raw", 14), ("raw", 15)]


def test_column_profile(spark):
    trips = processed(spark, {}, {"tip_amount": None}, {"tip_amount": "1.25"})
    for approximate in (False, True):
        rows = profile.column_profile(trips, ["tip_amount", "pickup_datetime"], approximate)
        found = {row.column_name: tuple(row)[1:] for row in rows.collect()}
        assert found == {
            "tip_amount": (3, 1, "1.250000", "5.000000", 2),
            "pickup_datetime": (3, 0, "2024-01-15 10:00:00", "2024-01-15 10:00:00", 1),
        }
