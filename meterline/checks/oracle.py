"""Check queries: SQL for another engine that gives the result of each registered query.

Written independently of the DataFrame code, apart from the trip mapping. Exactness: sums are added
as DECIMAL, means and shares are divided as integers in units of a cent, and per-trip values are
rounded from their shortest decimal text, which is how Spark rounds a DOUBLE.
"""

from __future__ import annotations

from meterline.plans.lineitem_trips import raw_trips_sql


def _round2(value: str) -> str:
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)"


def _units(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,6))) * 1000000 AS HUGEINT)"


def _half_up(top: str, bottom: str) -> str:
    return f"(2 * ({top}) + ({bottom})) // (2 * ({bottom}))"


def _sum2(column: str) -> str:
    return f"CAST({_half_up(_units(column), '10000')} AS DOUBLE) / 100"


def _mean2(column: str) -> str:
    return f"CAST({_half_up(_units(column), f'10000 * COUNT({column})')} AS DOUBLE) / 100"


def _mean_minutes(column: str) -> str:
    seconds = f"SUM(CAST(ROUND({column} * 60) AS BIGINT))"
    return f"CAST({_half_up(f'100 * {seconds}', f'60 * COUNT({column})')} AS DOUBLE) / 100"


def _mean(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,6))) AS DOUBLE) / COUNT({column})"


def _percent2(part: str, whole: str) -> str:
    return f"CAST({_half_up(f'10000 * {part}', whole)} AS DOUBLE) / 100"


_RULES = {
    "pickup_present": "pickup_datetime IS NOT NULL",
    "dropoff_present": "dropoff_datetime IS NOT NULL",
    "passengers_above_0": "passenger_count >= 1",
    "passengers_up_to_8": "passenger_count < 9",
    "distance_above_0": "trip_distance > 0",
    "distance_below_100": "trip_distance < 100",
    "fare_above_0": "fare_amount > 0",
    "fare_below_500": "fare_amount < 500",
    "total_above_0": "total_amount > 0",
    "pickup_before_dropoff": "dropoff_datetime > pickup_datetime",
}
_BROKEN = {name: f"NOT COALESCE({rule}, FALSE)" for name, rule in _RULES.items()}
_ALL_MET = " AND ".join(_RULES.values())

_TYPED = """
typed AS (
    SELECT TRY_CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
        TRY_CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
        CAST(TRUNC(TRY_CAST(passenger_count AS DOUBLE)) AS INTEGER) AS passenger_count,
        TRY_CAST(trip_distance AS DOUBLE) AS trip_distance,
        TRY_CAST(fare_amount AS DOUBLE) AS fare_amount,
        TRY_CAST(tip_amount AS DOUBLE) AS tip_amount,
        TRY_CAST(total_amount AS DOUBLE) AS total_amount,
        CAST(TRUNC(TRY_CAST(payment_type AS DOUBLE)) AS INTEGER) AS payment_type
    FROM raw
)"""
_TRIPS = f"""
kept AS (SELECT * FROM typed WHERE {_ALL_MET}),
timed AS (
    SELECT *, date_diff('second', pickup_datetime, dropoff_datetime) / 60 AS trip_duration_minutes
    FROM kept
),
measured AS (
    SELECT *,
        {_round2("trip_distance / trip_duration_minutes * 60")} AS avg_speed_mph,
        {_round2("tip_amount / fare_amount * 100")} AS tip_percentage
    FROM timed
),
trips AS (
    SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS year,
        CAST(month(pickup_datetime) AS INTEGER) AS month,
        CAST(day(pickup_datetime) AS INTEGER) AS day
    FROM measured
)"""
_DATED = """
dated AS (
    SELECT *, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
        CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
        CAST(pickup_datetime AS DATE) AS pickup_date
    FROM trips
)"""
_DAILY = f"""
daily AS (
    SELECT pickup_date, day, COUNT(*) AS total_trips, {_sum2("fare_amount")} AS total_revenue,
        {_sum2("tip_amount")} AS total_tips, {_mean2("trip_distance")} AS avg_trip_distance,
        {_mean_minutes("trip_duration_minutes")} AS avg_trip_duration,
        {_mean2("passenger_count")} AS avg_passengers,
        {_mean2("tip_percentage")} AS avg_tip_percentage,
        MAX(fare_amount) AS max_fare, MIN(fare_amount) AS min_fare, year, month
    FROM dated GROUP BY year, month, day, pickup_date
)"""
_HOURLY = f"""
hourly AS (
    SELECT pickup_hour, pickup_day_of_week,
        ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']
            [pickup_day_of_week] AS day_name,
        COUNT(*) AS trip_count, {_mean2("trip_distance")} AS avg_distance,
        {_mean_minutes("trip_duration_minutes")} AS avg_duration,
        {_mean2("fare_amount")} AS avg_fare, {_mean2("passenger_count")} AS avg_passengers,
        year, month
    FROM dated GROUP BY year, month, pickup_hour, pickup_day_of_week
)"""
_PAYMENT = f"""
payment AS (
    SELECT payment_type,
        COALESCE(['Credit Card', 'Cash', 'No Charge', 'Dispute'][payment_type], 'Unknown')
            AS payment_method,
        COUNT(*) AS transaction_count, {_sum2("total_amount")} AS total_revenue,
        {_mean2("tip_percentage")} AS avg_tip_percentage, {_mean2("fare_amount")} AS avg_fare,
        year, month
    FROM dated GROUP BY year, month, payment_type
)"""
_DISTANCE = f"""
bucketed AS (
    SELECT *, CASE WHEN trip_distance >= 20 THEN '20+ miles'
        WHEN trip_distance >= 10 THEN '10-20 miles' WHEN trip_distance >= 5 THEN '5-10 miles'
        WHEN trip_distance >= 3 THEN '3-5 miles' WHEN trip_distance >= 1 THEN '1-3 miles'
        ELSE '0-1 miles' END AS distance_bucket
    FROM dated
),
distance AS (
    SELECT distance_bucket, COUNT(*) AS trip_count, {_mean2("fare_amount")} AS avg_fare,
        {_mean_minutes("trip_duration_minutes")} AS avg_duration,
        {_sum2("total_amount")} AS total_revenue, year, month
    FROM bucketed GROUP BY year, month, distance_bucket
)"""

# Dates are compared as text, as the client libraries of the two engines return them differently.
_PICKUP_DATE = "strftime(pickup_date, '%Y-%m-%d') AS pickup_date"
_MONTH = "year = 2024 AND month = 1"
_SCALARS = {  # columns that column_profile reports, with the text form of a value
    "pickup_datetime": "strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S')",
    "dropoff_datetime": "strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S')",
    "passenger_count": "CAST(passenger_count AS VARCHAR)",
    "trip_distance": "CAST(CAST(trip_distance AS DECIMAL(18,6)) AS VARCHAR)",
    "fare_amount": "CAST(CAST(fare_amount AS DECIMAL(18,6)) AS VARCHAR)",
    "tip_amount": "CAST(CAST(tip_amount AS DECIMAL(18,6)) AS VARCHAR)",
    "total_amount": "CAST(CAST(total_amount AS DECIMAL(18,6)) AS VARCHAR)",
    "payment_type": "CAST(payment_type AS VARCHAR)",
}


def _with(*tables: str, select: str) -> str:
    return "WITH " + ",".join([raw_trips_sql(), *tables]) + "\n" + select.strip()


def _typed(select: str) -> str:
    return _with(_TYPED, select=select)


def _trips(select: str) -> str:
    return _with(_TYPED, _TRIPS, select=select)


def _curated(table: str, select: str) -> str:
    return _with(_TYPED, _TRIPS, _DATED, table, select=select)


_PROCESSED = """pickup_datetime, dropoff_datetime, passenger_count, trip_distance, fare_amount,
    tip_amount, total_amount, payment_type, trip_duration_minutes, avg_speed_mph, tip_percentage,
    year, month, day"""


_TRIPS_AND_DAYS = "COUNT(*) AS trips, COUNT(DISTINCT (year, month, day)) AS days"


def _of_some(sql: str) -> str:
    """Over the trips that are left when the files of payment types 3 and up are rewritten with type 3 alone."""
    return sql.replace("FROM trips", "FROM (SELECT * FROM trips WHERE payment_type < 4)")


def _column_profile() -> str:
    # Numbers are ordered as numbers, so the extremes are taken before they become text.
    parts = []
    for name, text in _SCALARS.items():
        low, high = (text.replace(name, f"{f}({name})") for f in ("MIN", "MAX"))
        parts.append(
            f"SELECT '{name}' AS column_name, COUNT(*) AS row_count,"
            f" COUNT(*) - COUNT({name}) AS null_count, {low} AS min_value, {high} AS max_value,"
            f" COUNT(DISTINCT {name}) AS distinct_count FROM typed"
        )
    return " UNION ALL ".join(parts)


def _age_tiers() -> str:
    layers = {
        "raw": ((180, "deep_archive"), (90, "archive"), (30, "infrequent")),
        "processed": ((180, "archive"), (60, "infrequent")),
        "curated": ((90, "infrequent"),),
    }
    selects = []
    for layer, tiers in layers.items():
        cases = " ".join(f"WHEN age_days >= {age} THEN '{tier}'" for age, tier in tiers)
        selects.append(
            f"SELECT '{layer}' AS layer, year, month, day, age_days,"
            f" CASE {cases} ELSE 'standard' END AS tier FROM aged"
        )
    return " UNION ALL ".join(selects)


_AGED = """
days AS (SELECT DISTINCT year, month, day FROM trips),
aged AS (
    SELECT *, date_diff('day', make_date(year, month, day), DATE '2025-07-01') AS age_days
    FROM days
)"""


STORED = (
    "daily_revenue_trends",
    "monthly_revenue_summary",
    "peak_hours",
    "weekend_vs_weekday",
    "payment_preferences",
    "distance_distribution_report",
)


def oracle_queries() -> dict[str, str]:
    broken_list = ", ".join(
        f"CASE WHEN {broken} THEN '{name}' END" for name, broken in _BROKEN.items()
    )
    reject_counts = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE {broken}) AS rejected_rows FROM typed"
        for name, broken in _BROKEN.items()
    )
    revenue_days = f"""
        SELECT {_PICKUP_DATE}, total_trips, total_revenue, total_tips,
            {_round2("total_revenue / total_trips")} AS revenue_per_trip,
            {_round2("total_tips / total_trips")} AS tips_per_trip, avg_tip_percentage
        FROM daily WHERE {_MONTH} ORDER BY daily.pickup_date DESC LIMIT """
    busy_hours = f"""
        SELECT pickup_hour, day_name, trip_count, avg_fare, avg_distance, avg_duration
        FROM hourly WHERE {_MONTH}
        ORDER BY trip_count DESC, pickup_day_of_week, pickup_hour LIMIT """
    statistics = f"""
        SELECT COUNT(*) AS rows_read, COUNT(*) FILTER (WHERE {_ALL_MET}) AS rows_kept,
            COUNT(*) FILTER (WHERE NOT COALESCE({_ALL_MET}, FALSE)) AS rows_rejected FROM typed"""
    processed = _trips(f"SELECT {_PROCESSED} FROM trips")
    daily = _curated(_DAILY, f"SELECT * REPLACE ({_PICKUP_DATE}) FROM daily")
    hourly = _curated(_HOURLY, "SELECT * FROM hourly")
    payment = _curated(_PAYMENT, "SELECT * FROM payment")
    distance = _curated(_DISTANCE, "SELECT * FROM distance")
    raw = _with(select="SELECT * FROM raw")
    checks = {
        "raw_scan": raw,
        "raw_csv_scan": raw,
        "typed_trips": _typed("SELECT * FROM typed"),
        "quality_filter": _typed(f"SELECT * FROM typed WHERE {_ALL_MET}"),
        "derived_metrics": _trips(
            """SELECT pickup_datetime, dropoff_datetime, trip_distance, fare_amount, tip_amount,
            total_amount, trip_duration_minutes, avg_speed_mph, tip_percentage FROM trips"""
        ),
        "processed_trips": processed,
        "processed_scan": processed,
        "incremental_ingest": processed,
        "nested_scan": raw,
        "projected_days": _trips(
            f"""SELECT {_PROCESSED} FROM trips
            WHERE make_date(year, month, day) BETWEEN DATE '2024-01-10' AND DATE '2024-03-05'"""
        ),
        "schema_versions": _trips(
            """SELECT pickup_datetime, total_amount, CAST(passenger_count AS DOUBLE) AS passenger_count,
            CASE WHEN payment_type >= 3 THEN CAST(payment_type AS BIGINT) END AS payment_type FROM trips"""
        ),
        "codec_sizes": _trips(
            """SELECT codec, COUNT(*) AS rows, codec <> 'uncompressed' AS smaller
            FROM trips, (VALUES ('uncompressed'), ('snappy'), ('gzip'), ('zstd'), ('lz4_raw')) AS c(codec) GROUP BY codec"""
        ),
        "catalog_tables": _trips(
            """SELECT year, month, COUNT(*) AS trips, COUNT(DISTINCT day) AS days,
            (SELECT COUNT(*) FROM raw) AS raw_rows FROM trips GROUP BY year, month"""
        ),
        "compacted_lake": _trips(
            f"""SELECT state, batches, {_TRIPS_AND_DAYS}, COUNT(*) AS daily_trips
            FROM trips, (VALUES ('two batches', 2), ('merged', 1), ('rewound', 2)) AS s(state, batches)
            GROUP BY state, batches"""
        ),
        "lease_log": """
            SELECT 1 AS number, 'first' AS holder, TRUE AS released, 0 AS rows_read
            UNION ALL SELECT 2, 'stuck', FALSE, 0
            UNION ALL SELECT 3, 'update', TRUE, COUNT(*) FROM lineitem""",
        "file_ledger": _typed(
            f"""SELECT 2 AS run, 'read' AS status, COUNT(*) AS rows_read, COUNT(*) FILTER (WHERE {_ALL_MET}) AS rows_kept
            FROM typed WHERE payment_type < 4"""
        ),
        "bookmark_rewind": _trips(
            f"""SELECT 'both runs' AS state, {_TRIPS_AND_DAYS} FROM trips
            UNION ALL SELECT 'rewound', {_TRIPS_AND_DAYS} FROM trips WHERE payment_type < 3
            UNION ALL SELECT 'updated', {_TRIPS_AND_DAYS} FROM trips"""
        ),
        "incremental_tables": _of_some(
            _with(
                _TYPED, _TRIPS, _DATED, _DAILY, _HOURLY, _PAYMENT, _DISTANCE,
                select=f"""SELECT 'daily_trip_statistics' AS table_name, * REPLACE ({_PICKUP_DATE}) FROM daily
                UNION ALL BY NAME SELECT 'hourly_trip_patterns' AS table_name, * FROM hourly
                UNION ALL BY NAME SELECT 'payment_type_analysis' AS table_name, * FROM payment
                UNION ALL BY NAME SELECT 'distance_distribution' AS table_name, * FROM distance""",
            )
        ),
        "time_dimensions": _with(
            _TYPED,
            _TRIPS,
            _DATED,
            select=f"""SELECT pickup_datetime, dropoff_datetime, total_amount, pickup_hour,
            pickup_day_of_week, {_PICKUP_DATE} FROM dated""",
        ),
        "daily_trip_statistics": daily,
        "hourly_trip_patterns": hourly,
        "payment_type_analysis": payment,
        "distance_distribution": distance,
        "curated_daily_from_cells": daily,
        "curated_hourly_from_cells": hourly,
        "curated_payment_from_cells": payment,
        "curated_distance_from_cells": distance,
        "daily_revenue_trends": _curated(_DAILY, revenue_days + "31"),
        "daily_revenue_trends_10": _curated(_DAILY, revenue_days + "10"),
        "top_revenue_days": _curated(
            _DAILY,
            f"""SELECT {_PICKUP_DATE}, total_revenue, total_trips FROM daily
            ORDER BY total_revenue DESC, daily.pickup_date LIMIT 10""",
        ),
        "kpi_totals": _curated(
            _DAILY,
            f"""SELECT CAST(SUM(total_trips) AS BIGINT) AS total_trips,
            {_sum2("total_revenue")} AS total_revenue FROM daily""",
        ),
        "monthly_revenue_summary": _curated(
            _DAILY,
            f"""SELECT year, month, CAST(SUM(total_trips) AS BIGINT) AS monthly_trips,
            {_sum2("total_revenue")} AS monthly_revenue, {_sum2("total_tips")} AS monthly_tips,
            {_mean2("avg_trip_distance")} AS avg_distance,
            {_mean2("avg_trip_duration")} AS avg_duration
            FROM daily GROUP BY year, month ORDER BY year DESC, month DESC""",
        ),
        "peak_hours": _curated(_HOURLY, busy_hours + "20"),
        "peak_hours_10": _curated(_HOURLY, busy_hours + "10"),
        "weekend_vs_weekday": _curated(
            _HOURLY,
            f"""SELECT CASE WHEN pickup_day_of_week IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END
            AS day_type, CAST(SUM(trip_count) AS BIGINT) AS total_trips,
            {_mean2("avg_fare")} AS avg_fare, {_mean2("avg_distance")} AS avg_distance,
            {_mean2("avg_duration")} AS avg_duration
            FROM hourly WHERE {_MONTH} GROUP BY 1 ORDER BY 1""",
        ),
        "metrics_by_day_of_week": _curated(
            _HOURLY,
            f"""SELECT day_name, CAST(SUM(trip_count) AS BIGINT) AS total_trips,
            {_mean2("avg_fare")} AS avg_fare, {_mean2("avg_distance")} AS avg_distance,
            {_mean2("avg_duration")} AS avg_duration_minutes
            FROM hourly WHERE {_MONTH} GROUP BY day_name, pickup_day_of_week
            ORDER BY pickup_day_of_week""",
        ),
        "payment_preferences": _curated(
            _PAYMENT,
            f"""SELECT payment_method, transaction_count, total_revenue,
            {_round2("total_revenue / transaction_count")} AS avg_transaction_value,
            avg_tip_percentage,
            {_percent2("transaction_count", "SUM(transaction_count) OVER ()")}
            AS percentage_of_total
            FROM payment WHERE {_MONTH} ORDER BY transaction_count DESC""",
        ),
        "distance_distribution_report": _curated(
            _DISTANCE,
            f"""SELECT distance_bucket, trip_count, total_revenue, avg_fare, avg_duration,
            {_percent2("trip_count", "SUM(trip_count) OVER ()")} AS percentage_of_trips
            FROM distance WHERE {_MONTH}""",
        ),
        "high_value_trips": _trips(
            f"""SELECT strftime(pickup_datetime, '%Y-%m-%d') AS trip_date, pickup_datetime,
            dropoff_datetime, trip_distance, trip_duration_minutes, fare_amount, tip_amount,
            total_amount, tip_percentage
            FROM trips WHERE {_MONTH} AND total_amount > 100
            ORDER BY total_amount DESC, pickup_datetime, dropoff_datetime LIMIT 50"""
        ),
        "tip_by_trip_category": _trips(
            f"""SELECT CASE WHEN trip_distance >= 10 THEN 'Very Long (10+ mi)'
            WHEN trip_distance >= 5 THEN 'Long (5-10 mi)'
            WHEN trip_distance >= 2 THEN 'Medium (2-5 mi)' ELSE 'Short (< 2 mi)' END
            AS trip_category, COUNT(*) AS trip_count,
            {_mean2("tip_percentage")} AS avg_tip_percentage,
            {_mean2("tip_amount")} AS avg_tip_amount, {_mean2("fare_amount")} AS avg_fare
            FROM trips WHERE {_MONTH} AND payment_type = 1 AND tip_amount > 0 GROUP BY 1"""
        ),
        "data_quality_check": _trips(
            f"""SELECT year, month, COUNT(*) AS total_records,
            COUNT(DISTINCT day) AS days_with_data, MIN(pickup_datetime) AS earliest_trip,
            MAX(pickup_datetime) AS latest_trip, {_mean2("trip_distance")} AS avg_distance,
            {_mean2("fare_amount")} AS avg_fare
            FROM trips WHERE {_MONTH} GROUP BY year, month"""
        ),
        "data_quality_global": _trips(
            f"""SELECT COUNT(*) AS total_records,
            COUNT(DISTINCT payment_type) AS unique_payment_types,
            MIN(pickup_datetime) AS earliest_trip, MAX(pickup_datetime) AS latest_trip,
            {_mean("trip_distance")} AS avg_distance, {_mean("fare_amount")} AS avg_fare
            FROM trips WHERE {_MONTH}"""
        ),
        "storage_estimate": _trips(
            """SELECT year, month, COUNT(*) AS record_count,
            CAST((COUNT(*) + 5) // 10 AS DOUBLE) / 10000 AS estimated_storage_gb
            FROM trips GROUP BY year, month ORDER BY year DESC, month DESC"""
        ),
        "benchmark_partition_agg": _trips(
            f"""SELECT COUNT(*) AS total_trips, {_mean2("fare_amount")} AS avg_fare,
            {_sum2("total_amount")} AS total_revenue
            FROM trips WHERE {_MONTH} AND day = 15"""
        ),
        "count_month": _trips(f"SELECT COUNT(*) AS total_trips FROM trips WHERE {_MONTH}"),
        "count_day": _trips(
            f"SELECT COUNT(*) AS total_trips FROM trips WHERE {_MONTH} AND day = 15"
        ),
        "partition_distribution": _trips(
            """SELECT year, month, day, COUNT(*) AS record_count FROM trips
            WHERE year = 2024 GROUP BY year, month, day ORDER BY year, month, day"""
        ),
        "partition_filter": _trips(
            f"SELECT {_PROCESSED} FROM trips WHERE {_MONTH} AND day = 15"
        ),
        "timestamp_range_filter": _trips(
            f"""SELECT {_PROCESSED} FROM trips
            WHERE pickup_datetime > TIMESTAMP '2024-01-15 00:00:00'"""
        ),
        "quality_rejects": _with(
            _TYPED.replace("FROM raw", ", raw.* RENAME (passenger_count AS raw_passengers, "
                           "trip_distance AS raw_distance, fare_amount AS raw_fare, "
                           "tip_amount AS raw_tip, total_amount AS raw_total, "
                           "payment_type AS raw_payment) FROM raw"),
            select=f"""SELECT tpep_pickup_datetime, tpep_dropoff_datetime, raw_passengers,
            raw_distance, raw_fare, raw_tip, raw_total, raw_payment,
            concat_ws(',', {broken_list}) AS broken_rules
            FROM typed WHERE NOT COALESCE({_ALL_MET}, FALSE)""",
        ),
        "reject_counts": _typed(reject_counts),
        "job_statistics": _typed(statistics),
        "column_profile": _typed(_column_profile()),
        "after_retention": _with(
            _TYPED,
            _TRIPS,
            _AGED,
            select="""SELECT trips.year, trips.month, COUNT(*) AS trips, COUNT(DISTINCT trips.day) AS days
            FROM trips JOIN aged USING (year, month, day) WHERE age_days <= 730 GROUP BY trips.year, trips.month""",
        ),
        "sketched_profile": _trips(
            f"SELECT column_name, row_count, null_count, min_value, max_value FROM ({_column_profile()})".replace(
                "FROM typed",
                "FROM (SELECT * FROM trips WHERE make_date(year, month, day) BETWEEN DATE '2024-01-10' AND DATE '2024-03-05')",
            )
        ),
        "partition_age_tiers": _with(_TYPED, _TRIPS, _AGED, select=_age_tiers()),
        "expired_partitions": _with(
            _TYPED,
            _TRIPS,
            _AGED,
            select="""SELECT 'raw' AS layer, year, month, day, age_days FROM aged
            WHERE age_days > 365 UNION ALL
            SELECT 'processed' AS layer, year, month, day, age_days FROM aged
            WHERE age_days > 730""",
        ),
    }
    # The same results through other formats and through stored tables.
    checks |= {name: raw for name in ("raw_json_scan", "raw_parquet_scan")}
    return checks | {f"stored_{name}": checks[name] for name in STORED}
