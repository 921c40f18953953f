"""What must hold for many files, large sums and several layouts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterline.plans import reports
from meterline.sources import catalog, layers, raw_files


def _write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_a_column_of_the_last_of_many_files_is_found(spark, tmp_path):
    folder = tmp_path / "raw"
    for i in range(30):
        _write(folder, f"{i:02}.csv", "fare,when\n1,2024-01-01\n")
    _write(folder, "99.csv", "when,surcharge,fare\n2024-01-02 10:00:00,0.5,2.5\n")
    found = catalog.found_schema(spark, str(folder), "csv")
    kinds = {f.name: f.dataType.simpleString() for f in found}
    assert kinds == {"fare": "double", "when": "timestamp", "surcharge": "double"}
    rows = raw_files.read_csv(spark, str(folder))
    assert rows.count() == 31 and rows.where("surcharge = '0.5' AND fare = '2.5'").count() == 1


def test_json_columns_of_all_files_are_found(spark, tmp_path):
    folder = tmp_path / "raw"
    for i in range(25):
        _write(folder, f"{i:02}.json", '{"fare": 1}\n')
    _write(folder, "99.json", '{"fare": 1.5, "extra": "x"}\n')
    found = catalog.found_schema(spark, str(folder), "json")
    assert {f.name: f.dataType.simpleString() for f in found} == {"fare": "double", "extra": "string"}


def test_headers_come_from_a_scan_without_python(spark, tmp_path):
    folder = tmp_path / "raw"
    for i in range(3):
        _write(folder, f"{i}.csv", "a,b\n" + "1,2\n" * 2000)
    headers = raw_files.csv_headers(spark, str(folder))
    assert [r.header for r in headers.collect()] == ["a,b"] * 3
    plan = headers._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _daily(spark, pieces):
    low, high = 12_000_000.37, 20_000_000_000.91
    rows = [(2024, 1, 10, low + (high - low) * i / 2000 // 0.01 * 0.01, 0.1 + i % 7, 1.5, 2.5) for i in range(2000)]
    names = "year int, month int, total_trips long, total_revenue double, total_tips double, avg_trip_distance double, avg_trip_duration double"
    return spark.createDataFrame(rows, names).repartition(pieces)


@pytest.mark.parametrize("report", [reports.kpi_totals, reports.monthly_revenue_summary])
def test_large_daily_sums_do_not_depend_on_the_partitions(spark, report):
    found = {tuple(report(_daily(spark, n)).first()) for n in (1, 7, 64)}
    assert len(found) == 1
    exact = _daily(spark, 4).agg(F.sum(F.col("total_revenue").cast("decimal(38,6)"))).first()[0]
    assert float(round(exact, 2)) in [v for v in found.pop() if isinstance(v, float)]


def test_infinite_and_missing_values_still_add_up(spark):
    rows = [(2024, 1, 1, float("inf"), 1.0, 1.0, 1.0), (2024, 1, 1, 5e7, None, 1.0, 1.0)]
    names = _daily(spark, 1).schema
    got = reports.monthly_revenue_summary(spark.createDataFrame(rows, names)).first()
    assert got.monthly_revenue == float("inf") and got.monthly_tips == 1.0


def test_many_days_make_few_files(spark, tmp_path):
    days = spark.range(60_000).select(
        F.lit(2024).alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"), (F.col("id") % 60 % 28 + 1).cast("int").alias("day"), F.col("id").alias("n")
    )
    layers.append_processed(days, f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    folders = stored.select("year", "month", "day").distinct().count()
    assert len(stored.inputFiles()) <= 1.5 * folders
