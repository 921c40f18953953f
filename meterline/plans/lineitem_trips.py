"""Raw trips derived from the ``lineitem`` table, the large input of tests, checks and benchmarks.

The expressions are SQL text that Spark and the checking engine both read: integer arithmetic and
decimal text only, so that both make the same strings. Some values are bad on purpose, to break
each rule. Dates are moved 28 years on, which keeps the weekdays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_TIMESTAMP = "CAST({} AS VARCHAR(30))"


def _cents_text(cents: str) -> str:
    amount = f"CAST(CAST({cents} AS DECIMAL(12,0)) * 0.01 AS DECIMAL(12,2))"
    return f"CAST({amount} AS VARCHAR(20))"


# Each step adds named columns to the ones before it.
_STEPS: tuple[dict[str, str], ...] = (
    {
        "base": "l_shipdate + INTERVAL '28' YEAR",
        "k": "l_orderkey * 13 + l_partkey * 7 + l_linenumber * 3",
        "s0": "(l_orderkey * 7919 + l_partkey * 1047 + l_linenumber * 12997) % 86400",
        "dur": "60 + (l_partkey * 31 + l_suppkey * 17 + l_linenumber * 7) % 5400",
        "q": "CAST(ROUND(l_quantity) AS BIGINT)",
        "p": "CAST(ROUND(l_extendedprice) AS BIGINT)",
        "x": "CAST(ROUND(l_tax * 100) AS BIGINT)",
        "line": "l_linenumber",
        "vendor": "1 + l_suppkey % 2",
    },
    {
        "dist": "CASE WHEN k % 101 = 0 THEN 0 WHEN k % 103 = 0 THEN 15000"
        " ELSE q * 45 + line * 10 END",
        "fare": "CASE WHEN k % 107 = 0 THEN 50000 + p % 1000 WHEN k % 109 = 0 THEN 0"
        " ELSE 300 + p % 20000 END",
        "tip": "(k % 30) * 35",
        "ends": "CASE WHEN k % 89 = 0 THEN s0 - dur ELSE s0 + dur END",
    },
    {"total": "CASE WHEN k % 127 = 0 THEN -100 ELSE fare + tip + x * 25 END"},
)
_RAW = {
    "VendorID": "CAST(vendor AS VARCHAR(20))",
    "tpep_pickup_datetime": "CASE WHEN k % 113 = 0 THEN 'bad-ts' ELSE "
    + _TIMESTAMP.format("base + INTERVAL '1' SECOND * s0")
    + " END",
    "tpep_dropoff_datetime": _TIMESTAMP.format("base + INTERVAL '1' SECOND * ends"),
    "passenger_count": "CASE WHEN k % 97 = 0 THEN NULL WHEN k % 83 = 0 THEN 'n/a'"
    " WHEN k % 2 = 0 THEN CAST(k % 10 AS VARCHAR(20)) || '.0'"
    " ELSE CAST(k % 10 AS VARCHAR(20)) END",
    "trip_distance": _cents_text("dist"),
    "fare_amount": _cents_text("fare"),
    "tip_amount": _cents_text("tip"),
    "total_amount": _cents_text("total"),
    "payment_type": "CAST(1 + k % 6 AS VARCHAR(20))",
}


def _rounded(value: str) -> str:
    """``CAST(ROUND(value) AS BIGINT)`` without the decimals that ROUND goes through in Spark, half of the cost of a raw
    trip. What is cut off a double is exact, so halves go away from zero alike."""
    whole = f"CAST({value} AS BIGINT)"
    return f"{whole} + CASE WHEN {value} - {whole} >= 0.5D THEN 1 WHEN {value} - {whole} <= -0.5D THEN -1 ELSE 0 END"


_IN_SPARK = {"q": _rounded("l_quantity"), "p": _rounded("l_extendedprice"), "x": _rounded("(l_tax * 100)")}


def _aliased(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    frame = spark.read.parquet(f"{folder}/lineitem.parquet")
    known: list[str] = []
    for step in _STEPS:
        in_spark = {name: _IN_SPARK.get(name, expression) for name, expression in step.items()}
        frame = frame.selectExpr(*known, *_aliased(in_spark))
        known += list(step)
    return frame.selectExpr(*_aliased(_RAW))


def raw_trips_sql() -> str:
    """The same columns as common table expressions, the last one named ``raw``."""
    tables, source, known = [], "lineitem", []
    for number, step in enumerate(_STEPS):
        columns = ", ".join([*known, *_aliased(step)])
        tables.append(f"step{number} AS (SELECT {columns} FROM {source})")
        source, known = f"step{number}", [*known, *step]
    tables.append(f"raw AS (SELECT {', '.join(_aliased(_RAW))} FROM {source})")
    return ",\n".join(tables)
