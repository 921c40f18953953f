from __future__ import annotations

import pytest

from meterline.checks.oracle import oracle_queries
from meterline.checks.registry import registered
from meterline.functions import exact
from meterline.plans import curated, reports
from pyspark.sql import functions as F

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
TABLES = ("lineitem",)


@pytest.fixture(scope="module")
def checker():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{FOLDER}/{name}.parquet'")
    return connection


# Reports whose rows come in a stated, total order.
ORDERED = {
    "daily_revenue_trends",
    "top_revenue_days",
    "monthly_revenue_summary",
    "peak_hours",
    "weekend_vs_weekday",
    "metrics_by_day_of_week",
    "high_value_trips",
    "partition_distribution",
}
# Those whose order leaves ties open, with the column they are ordered by.
ORDERED_BY = {"payment_preferences": "transaction_count"}


def as_text(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return [tuple(str(row[place]) for place in order) for row in rows]


@pytest.mark.parametrize("name", sorted(registered()))
def test_same_as_other_engine(spark, checker, name):
    frame = registered()[name](spark, FOLDER)
    ours = frame.collect()
    theirs = checker.execute(oracle_queries()[name])
    columns = [column[0] for column in theirs.description]
    assert sorted(columns) == sorted(frame.columns)
    left, right = as_text(frame.columns, ours), as_text(columns, theirs.fetchall())
    if name.removeprefix("stored_") in ORDERED:
        assert left == right
    if key := ORDERED_BY.get(name.removeprefix("stored_")):
        at = sorted(columns).index(key)
        assert [row[at] for row in left] == [row[at] for row in right]
    assert sorted(left) == sorted(right)


def test_every_query_has_a_check():
    assert set(registered()) == set(oracle_queries())


def test_percentage_is_rounded_half_up(spark):
    row = spark.sql("SELECT 1L AS part, 32L AS whole, 0L AS none").select(
        exact.percentage(F.col("part"), F.col("whole")).alias("share"),
        exact.percentage(F.col("part"), F.col("none")).alias("nothing"),
    )
    assert tuple(row.first()) == (3.13, None)  # 3.125


def test_shares_are_of_the_chosen_month(spark):
    rows = [(1, "Credit Card", 30, 1.0, 1.0, 1.0, 2024, 1), (2, "Cash", 10, 1.0, 1.0, 1.0, 2024, 1)]
    rows += [(1, "Credit Card", 999, 1.0, 1.0, 1.0, 2024, 2)]
    columns = "payment_type INT, payment_method STRING, transaction_count BIGINT,"
    columns += "total_revenue DOUBLE, avg_tip_percentage DOUBLE, avg_fare DOUBLE, year INT, month INT"
    shares = reports.payment_preferences(spark.createDataFrame(rows, columns)).collect()
    assert [row.percentage_of_total for row in shares] == [75.0, 25.0]


def test_other_months_can_be_asked_for(spark):
    trips = spark.createDataFrame([(2023, 5, 1), (2023, 5, 2), (2024, 1, 1)], "year INT, month INT, day INT")
    assert reports.count_trips(trips, 2023, 5).first().total_trips == 2
    assert reports.count_trips(trips, 2023, 5, 2).first().total_trips == 1


def test_empty_day_has_no_sums(spark):
    trips = spark.createDataFrame([], "fare_amount DOUBLE, total_amount DOUBLE, year INT, month INT, day INT")
    assert tuple(reports.benchmark_partition_agg(trips).first()) == (0, None, None)


def test_limited_reports_use_top_k(spark):
    """ORDER BY with LIMIT must not sort the whole table."""
    daily = curated.from_trips(curated.DAILY, registered()["processed_trips"](spark, FOLDER))
    plan = reports.top_revenue_days(daily)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
