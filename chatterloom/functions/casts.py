"""Casts that accept what a tolerant message reader accepts, else give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numeric times beyond this many seconds are milliseconds.
_MILLIS_FROM = 2e10


def whole_number(text: Column) -> Column:
    """``5``, ``"5"`` and ``5.0`` are 5; ``5.5`` and ``abc`` are null."""
    value = text.try_cast("double")
    return F.when(value == F.floor(value), value.try_cast("int"))


def point_in_time(text: Column) -> Column:
    """ISO-8601 text or epoch seconds / milliseconds as a timestamp."""
    number = text.try_cast("double")
    seconds = F.when(F.abs(number) > _MILLIS_FROM, number / 1000).otherwise(number)
    # Dates first: no date is a number, and a cast that fails is costly.
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}($|[T ])"), F.try_to_timestamp(text)).otherwise(
        F.timestamp_seconds(seconds)
    )


# Read as text from the message, then cast by these.
TOLERANT = {
    "timestamp": point_in_time,
    "int": whole_number,
    "double": lambda text: text.try_cast("double"),
    "boolean": lambda text: text.try_cast("boolean"),
}
