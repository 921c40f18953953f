"""Versions of a schema, and old batches under the newest."""

from __future__ import annotations

import pytest

from meterline.sources import schema_log


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def _rows(frame):
    return sorted((tuple(row) for row in frame.drop("ingest_batch").collect()), key=str)


def test_int_to_bigint_to_double(spark, root):
    for number, text in enumerate(("1 AS a", "2L AS a", "3 AS a", "4.5D AS a", "5L AS a")):
        schema_log.append(spark, root, spark.sql(f"SELECT {text}"), f"b{number}")
    assert schema_log.latest(spark, root)[0] == 3
    found = schema_log.read(spark, root)
    assert dict(found.dtypes)["a"] == "double"
    assert _rows(found) == [(1.0,), (2.0,), (3.0,), (4.5,), (5.0,)]
    older = schema_log.read(spark, root, version=2)
    assert dict(older.dtypes)["a"] == "bigint" and _rows(older) == [(1,), (2,), (3,)]
    log = [tuple(r) for r in schema_log.history(spark, root).where("change <> 'first'").orderBy("version").collect()]
    assert log == [(2, "b1", "a", "changed", "int", "bigint"), (3, "b3", "a", "changed", "bigint", "double")]


def test_added_and_missing_columns(spark, root):
    schema_log.append(spark, root, spark.sql("SELECT 1 AS a, 'x' AS b"), "b0")
    schema_log.append(spark, root, spark.sql("SELECT 0.5D AS c, 2 AS A"), "b1")
    schema_log.append(spark, root, spark.sql("SELECT 3 AS a, 'y' AS b"), "b2")
    found = schema_log.read(spark, root)
    assert found.columns == ["a", "b", "c", "ingest_batch"]
    assert _rows(found) == [(1, "x", None), (2, None, 0.5), (3, "y", None)]
    log = schema_log.history(spark, root).where("change <> 'first'")
    assert {(r.version, r.batch, r.column_name, r.change) for r in log.collect()} == {
        (2, "b1", "c", "added"), (2, "b1", "b", "missing"), (2, "b2", "c", "missing"),
    }


def test_other_types_become_text(spark, root):
    schema_log.append(spark, root, spark.sql("SELECT 1 AS a, DATE '2024-01-02' AS d"), "b0")
    schema_log.append(spark, root, spark.sql("SELECT 'n/a' AS a, TIMESTAMP '2024-01-03 04:05:06' AS d"), "b1")
    found = schema_log.read(spark, root)
    assert dict(found.dtypes) == {"a": "string", "d": "timestamp", "ingest_batch": "string"}
    rows = {r.a: str(r.d) for r in found.collect()}
    assert rows == {"1": "2024-01-02 00:00:00", "n/a": "2024-01-03 04:05:06"}


def test_equal_schemas_share_a_record(spark, root):
    numbers = [
        schema_log.append(spark, root, spark.sql(f"SELECT {text}"), f"b{i}")
        for i, text in enumerate(("1 AS a, 2 AS b", "1 AS a", "1 AS a, 2 AS b", "3 AS a", "4L AS a", "5 AS a"))
    ]
    assert numbers == [1, 2, 1, 2, 3, 4]
    assert schema_log.read(spark, root).count() == 6


def test_a_second_attempt_replaces_the_first(spark, root):
    for text in ("1 AS a", "2 AS a"):
        schema_log.append(spark, root, spark.sql(f"SELECT {text}"), "b0")
    schema_log.append(spark, root, spark.sql("SELECT 3L AS a"), "b1")
    schema_log.append(spark, root, spark.sql("SELECT 4 AS a"), "b0")
    assert _rows(schema_log.read(spark, root)) == [(3,), (4,)]


def test_names_with_marks_and_empty_batches(spark, root):
    schema_log.append(spark, root, spark.sql("SELECT 1 AS `a b`, 2 AS `c``d`").limit(0), "b0")
    assert schema_log.read(spark, root).count() == 0
    schema_log.append(spark, root, spark.sql("SELECT 1 AS `a b`, 2L AS `c``d`"), "b1")
    assert _rows(schema_log.read(spark, root)) == [(1, 2)]


def test_no_batches(spark, root):
    assert schema_log.latest(spark, root) is None
    with pytest.raises(ValueError, match="no version"):
        schema_log.read(spark, root)
