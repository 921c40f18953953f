"""Column statistics as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        plain = value.try_cast("decimal(18,6)").cast("string")
        return F.coalesce(plain, value.cast("string"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return value.cast("string")


def column_profile(
    frame: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Rows, NULLs, extremes and distinct values of each column, from one read of the table.

    Exact distinct counts shuffle the distinct values of each column, once per task that saw them.
    With ``approximate`` they are sketches of fixed size, and nothing shuffled grows with the data.
    """
    columns = list(columns or frame.columns)
    count_values = F.approx_count_distinct if approximate else F.count_distinct
    entries = []
    for name in columns:
        column, kind = F.col(name), frame.schema[name].dataType
        entries += [
            F.count(column).alias(f"{name}_n"),
            F.min(column).alias(f"{name}_min"),
            F.max(column).alias(f"{name}_max"),
            count_values(column).alias(f"{name}_distinct"),
        ]
    summary = frame.agg(F.count(F.lit(1)).alias("rows"), *entries)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"{name}_n")).alias("null_count"),
            _as_text(F.col(f"{name}_min"), frame.schema[name].dataType).alias("min_value"),
            _as_text(F.col(f"{name}_max"), frame.schema[name].dataType).alias("max_value"),
            F.col(f"{name}_distinct").alias("distinct_count"),
        )
        for name in columns
    ]
    return summary.select(F.inline(F.array(*rows)))
