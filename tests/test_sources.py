from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from meterline.operators import trips
from meterline.plans import curated, reports
from meterline.sources import layers, raw_files
from tests.trip_rows import GOOD, HEADER, LINE, processed, raw


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")
    return str(path)


def test_suffixes_depth_and_case(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER, LINE)
    write(tmp_path / "2024" / "01" / "B.CSV", HEADER, LINE)
    write(tmp_path / "notes.txt", HEADER, LINE)
    write(tmp_path / "c.json", json.dumps(GOOD))
    write(tmp_path / "odd [1] {x}.csv", HEADER, LINE)
    frame = raw_files.read_raw(spark, str(tmp_path))
    assert frame.count() == 4
    names = {os.path.basename(row.source_file) for row in frame.collect()}
    assert names == {"a.csv", "B.CSV", "c.json", "odd%20%5B1%5D%20%7Bx%7D.csv"}
    assert trips.processed_trips(frame).distinct().count() == 1


def test_columns_are_found_by_name(spark, tmp_path):
    names, values = HEADER.split(","), LINE.split(",")
    write(tmp_path / "plain.csv", HEADER, LINE)
    write(tmp_path / "turned [v2].csv", ",".join(names[::-1]), ",".join(values[::-1]))
    write(tmp_path / "fewer.csv", ",".join(names[1:]), ",".join(values[1:]))
    write(tmp_path / "more.csv", "note," + HEADER, '"a, b",' + LINE)
    rows = trips.processed_trips(raw_files.read_raw(spark, str(tmp_path))).collect()
    assert len(rows) == 4 and len(set(rows)) == 1
    assert rows[0].fare_amount == 25.5


def test_headers_are_checked_while_scanning(spark, tmp_path):
    """If a file changed after its header was read, the scan fails and no column is misread."""
    write(tmp_path / "a.csv", HEADER, LINE)
    frame = raw_files.read_csv(spark, str(tmp_path))
    write(tmp_path / "a.csv", ",".join(HEADER.split(",")[::-1]), LINE)
    spark.catalog.refreshByPath(str(tmp_path))
    with pytest.raises(Exception, match="CSV header does not conform"):
        frame.select("fare_amount").collect()


def test_formats_agree(spark, tmp_path):
    changes = [{}, {"passenger_count": "9"}, {"trip_distance": "12.25"}, {"tip_amount": None}]
    rows = raw(spark, *changes)
    rows.write.option("header", True).csv(f"{tmp_path}/csv")
    rows.write.json(f"{tmp_path}/json")
    typed = rows.selectExpr(
        "CAST(tpep_pickup_datetime AS TIMESTAMP)", "CAST(tpep_dropoff_datetime AS TIMESTAMP)",
        "CAST(passenger_count AS BIGINT)", "CAST(trip_distance AS DOUBLE)",
        "CAST(fare_amount AS DOUBLE)", "CAST(tip_amount AS DOUBLE)",
        "CAST(total_amount AS DOUBLE)", "CAST(payment_type AS DOUBLE)",
    )
    typed.write.parquet(f"{tmp_path}/parquet")
    results = [
        sorted(map(str, trips.processed_trips(raw_files.read_raw(spark, f"{tmp_path}/{kind}")).collect()))
        for kind in raw_files.FORMATS
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == 3
    assert trips.processed_trips(raw_files.read_raw(spark, str(tmp_path))).count() == 9


def test_parquet_types_that_differ_by_month(spark, tmp_path):
    """Published files have a column as BIGINT in some months and as DOUBLE in others."""
    for month, kind in enumerate(["BIGINT", "BIGINT", "DOUBLE", "BIGINT", "DOUBLE"], 1):
        rows = raw(spark).withColumn("passenger_count", F.expr(f"CAST(passenger_count AS {kind})"))
        rows.coalesce(1).write.parquet(f"{tmp_path}/a b/2024-0{month}")
    found = raw_files.read_raw(spark, str(tmp_path))
    assert found.count() == 5
    assert {row.passenger_count for row in trips.processed_trips(found).collect()} == {2}


def test_bad_json_line_keeps_its_text(spark, tmp_path):
    write(tmp_path / "a.json", json.dumps(GOOD), "{not json")
    rows = raw_files.read_raw(spark, str(tmp_path)).collect()
    assert {row._corrupt_record for row in rows} == {None, "{not json"}


def test_missing_used_column_is_null(spark, tmp_path):
    write(tmp_path / "a.csv", "tpep_pickup_datetime,fare_amount", "2024-01-15 10:00:00,5")
    frame = raw_files.read_raw(spark, str(tmp_path))
    assert frame.first().total_amount is None
    assert trips.processed_trips(frame).isEmpty()


def test_no_files(spark, tmp_path):
    assert trips.processed_trips(raw_files.read_raw(spark, str(tmp_path))).isEmpty()


def test_empty_and_header_only_files(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER, LINE)
    write(tmp_path / "b.csv", HEADER)
    open(tmp_path / "c.csv", "w").close()
    assert raw_files.read_raw(spark, str(tmp_path)).count() == 1


def test_append_adds_and_keeps(spark, tmp_path):
    path = f"{tmp_path}/p"
    for _ in range(2):
        layers.append_processed(processed(spark), path)
    assert layers.read_processed(spark, path).count() == 2
    assert os.path.isdir(f"{path}/year=2024/month=1/day=15")


@pytest.mark.parametrize("codec", ["snappy", "gzip", "zstd"])
def test_compression(spark, tmp_path, codec):
    layers.append_processed(processed(spark), f"{tmp_path}/p", compression=codec)
    day = f"{tmp_path}/p/year=2024/month=1/day=15"
    suffix = "gz" if codec == "gzip" else codec
    (load,) = os.listdir(day)
    assert [name for name in os.listdir(f"{day}/{load}") if name.endswith(f".{suffix}.parquet")]


def test_batches_replace_only_themselves(spark, tmp_path):
    path, keys = f"{tmp_path}/p", ("year", "month", "day")
    for batch in ("a-0", "a-1", "a-1"):
        layers.write_ingest_batch(processed(spark), path, batch, keys)
    assert layers.read_processed(spark, path).count() == 2


def test_curated_overwrite_all_or_some_months(spark, tmp_path):
    january = processed(spark)
    february = processed(
        spark,
        {
            "tpep_pickup_datetime": "2024-02-01 00:00:00",
            "tpep_dropoff_datetime": "2024-02-01 00:10:00",
        },
    )
    lake = layers.Lake(str(tmp_path), raw="")
    path = lake.curated("daily_trip_statistics")

    def months():
        return {row.month for row in layers.read_curated(spark, lake, "daily_trip_statistics").collect()}

    layers.write_curated(curated.from_trips(curated.DAILY, january), path)
    layers.write_curated(curated.from_trips(curated.DAILY, february), path, keep_other_months=True)
    assert months() == {1, 2}
    layers.write_curated(curated.from_trips(curated.DAILY, february), path)
    assert months() == {2}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('stored')}/p"
    changes = [
        {
            "tpep_pickup_datetime": f"2024-{month:02d}-{day:02d} 10:00:00",
            "tpep_dropoff_datetime": f"2024-{month:02d}-{day:02d} 10:30:00",
        }
        for month in (1, 2)
        for day in (1, 14, 15, 16)
    ]
    layers.append_processed(processed(spark, *changes), path)
    return path


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_reports_prune_partitions_and_columns(spark, stored):
    frame = reports.benchmark_partition_agg(layers.read_processed(spark, stored))
    plan = plan_of(frame)
    assert frame.first().total_trips == 1
    assert "(year#" in plan.split("PartitionFilters")[1] and "(day#" in plan.split("PartitionFilters")[1]
    assert "ReadSchema: struct<fare_amount:double,total_amount:double>" in plan


def test_time_range_prunes_partitions_and_is_pushed(spark, stored):
    frame = reports.picked_up_after(layers.read_processed(spark, stored), "2024-01-15")
    assert frame.count() == 6
    plan = plan_of(frame)
    assert "(make" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThan(pickup_datetime" in plan.split("PushedFilters")[1]


def test_count_reads_no_column(spark, stored):
    plan = plan_of(reports.count_trips(layers.read_processed(spark, stored), 2024, 1))
    assert "ReadSchema: struct<>" in plan


def test_curated_tables_shuffle_once(spark, stored):
    for table in curated.TABLES:
        plan = plan_of(curated.from_trips(table, layers.read_processed(spark, stored)))
        assert plan.count("Exchange") == 1, table.name


def test_transform_does_not_shuffle(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER, LINE)
    plan = plan_of(trips.processed_trips(raw_files.read_raw(spark, str(tmp_path))))
    assert "Exchange" not in plan and "Python" not in plan
    assert "VendorID" not in plan.split("ReadSchema")[1]
