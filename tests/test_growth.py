"""Steps whose cost must not grow faster than their input."""

from __future__ import annotations

from pathlib import Path

from meterline.checks import registry
from meterline.operators import trips
from meterline.plans import lineitem_trips
from meterline.sources import layers, raw_files
from meterline.streaming import ledger
from tests.trip_rows import HEADER, LINE, processed


def test_each_stored_report_refreshes_a_lake_of_its_own(spark, monkeypatch):
    made, shown = [], []
    monkeypatch.setattr(registry, "_raw_as_csv", lambda spark, folder: "raw")
    monkeypatch.setattr(registry.journal, "changes", lambda spark, path: (0, 0))
    monkeypatch.setattr(registry.refresh, "refresh", lambda spark, lake: made.append(lake))
    monkeypatch.setattr(registry.layers, "read_curated", lambda spark, lake, table: shown.append(lake) or spark.range(1))
    for name in ("stored_daily_revenue_trends", "stored_monthly_revenue_summary"):
        build = registry._stored(registry.curated.DAILY, lambda table: table)
        assert build(spark, name[:6]).count() == 1
    assert len({lake.root for lake in made}) == 2
    assert made == shown


def test_rounding_without_decimals_is_that_of_round(spark):
    values = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 1e15 + 0.5, 4503599627370495.5]
    values += [9007199254740992.0, 0.07 * 100, 0.285 * 100, -1.4999999999999998, 0.0, -0.0, None]
    frame = spark.createDataFrame([(value,) for value in values], "v DOUBLE")
    found = frame.selectExpr(f"{lineitem_trips._rounded('v')} AS ours", "CAST(ROUND(v) AS BIGINT) AS theirs").collect()
    assert [row.ours for row in found] == [row.theirs for row in found]
    assert "round(" not in lineitem_trips._IN_SPARK["p"].lower()


def test_headers_of_a_few_files_are_found_without_a_scan(spark, tmp_path, monkeypatch):
    def scan(*_):
        raise AssertionError("files are scanned for their headers")

    (tmp_path / "a b%20[1].csv").write_bytes(b"\xef\xbb\xbf" + f"{HEADER}\r\n{LINE}\r\n".encode())
    (tmp_path / "plain.csv").write_text(f"{HEADER}\n{LINE}\n")
    turned = [",".join(reversed(text.split(","))) for text in (HEADER, LINE)]
    (tmp_path / "turned.csv").write_text("\n".join(turned))
    (tmp_path / "empty.csv").write_text("")
    slow = raw_files._scanned_layouts(spark, str(tmp_path))
    monkeypatch.setattr(raw_files, "csv_headers", scan)
    fast = raw_files._layouts(spark, str(tmp_path))
    names = lambda found: {key: sorted(Path(name).name for name in files) for key, files in found.items()}
    assert set(fast) == {HEADER, turned[0]}
    assert {key.strip(): files for key, files in names(slow).items()} == names(fast)
    assert trips.processed_trips(raw_files.read_raw(spark, str(tmp_path))).count() == 3


def test_a_batch_is_read_from_its_months_alone(spark, tmp_path):
    later = {"tpep_pickup_datetime": "2024-02-16 10:00:00", "tpep_dropoff_datetime": "2024-02-16 10:05:00"}
    frame, more = processed(spark, {}), processed(spark, later)
    for batch in ("run-1", "run-2"):
        layers.write_ingest_batch(frame, str(tmp_path), batch, layers.DAY_KEYS, replace=False)
    layers.write_ingest_batch(more, str(tmp_path), "run-3", layers.DAY_KEYS, replace=False)
    found = layers.read_batch(spark, str(tmp_path), "run-2", [202401])
    assert sorted(map(str, found.collect())) == sorted(map(str, frame.collect()))
    assert all("/month=1/" in path for path in found.inputFiles())


def test_cells_of_a_batch_come_from_its_stored_trips(spark, tmp_path, monkeypatch):
    made = []
    cells = ledger.curated.cells
    monkeypatch.setattr(ledger.curated, "cells", lambda frame: made.append(frame.inputFiles()) or cells(frame))
    lake = layers.Lake(str(tmp_path / "lake"), raw=str(tmp_path / "raw"))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "one.csv").write_text(f"{HEADER}\n{LINE}\n")
    ledger.ingest_changes(spark, lake)
    assert made and all(lake.processed in path for path in made[0])
    assert layers.read_batches(spark, lake.cells).agg({"trips": "sum"}).first()[0] == 1


def test_notes_beside_nested_files_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "new_shared_path", lambda spark, label: str(tmp_path / label))
    schema = "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    schema += "l_extendedprice DOUBLE, l_tax DOUBLE, l_shipdate TIMESTAMP_NTZ"
    rows = spark.range(3000).selectExpr(
        "id", "id % 700", "id % 10", "CAST(id % 7 AS INT)", "CAST(id % 50 AS DOUBLE)", "id * 1.01D", "0.05D",
        "TIMESTAMP_NTZ '1996-01-01' + make_dt_interval(CAST(id % 900 AS INT))",
    )
    rows.toDF(*[field.split()[0] for field in schema.split(", ")]).write.parquet(str(tmp_path / "in/lineitem.parquet"))
    assert registry._nested_scan(spark, str(tmp_path / "in")).count() == 3000
    notes = tmp_path / "nested/b/notes"
    stored = sum(path.stat().st_size for path in notes.glob("part-*"))
    lines = spark.read.text(str(notes))
    assert lines.count() == 3000
    assert stored < lines.selectExpr("sum(length(value) + 1)").first()[0] / 2
