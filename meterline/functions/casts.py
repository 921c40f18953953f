"""String parsing that gives NULL for bad text and keeps the session's ANSI mode as it is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# '2.0' and '2.7' both count as 2; '2.x' and '2e0' are not integers.
_INTEGER_OR_FRACTION = r"^\s*[+-]?[0-9]+(\.[0-9]*)?\s*$"


def to_int(text: Column) -> Column:
    # A failing try_cast to INT costs an exception per row, so only text that will pass reaches it.
    fits = text.rlike(_INTEGER_OR_FRACTION)
    return F.when(fits, F.substring_index(text, ".", 1)).try_cast("int")


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_time(text: Column) -> Column:
    return text.try_cast("timestamp")
