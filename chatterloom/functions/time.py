"""Time expressions. All buckets follow the session time zone (UTC)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIRST_MONDAY = date(1970, 1, 5)
GRAINS = ("hour", "day", "week")


def bucket_start(grain: str, time: Column) -> Column:
    """Start of the hour, day or ISO week (Monday) that holds ``time``."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}, expected one of {GRAINS}")
    return F.date_trunc(grain, time)


def chunk_start(time: Column, days: int) -> Column:
    """First day of the ``days``-long chunk that holds ``time``.

    Chunks count from a Monday, so that chunks of seven days are ISO weeks.
    """
    number = F.datediff(F.to_date(time), F.lit(_FIRST_MONDAY))
    return F.date_add(F.lit(_FIRST_MONDAY), (F.floor(number / days) * days).cast("int"))


def chunk_bounds(
    since: date | None, until: date | None, days: int
) -> tuple[date | None, date | None]:
    """``since <= day < until`` widened to whole chunks."""
    def shifted(day: date, extra: int) -> date:
        number = (day - _FIRST_MONDAY).days + extra
        return _FIRST_MONDAY + timedelta(days=number // days * days)

    return (
        None if since is None else shifted(since, 0),
        None if until is None else shifted(until, days - 1),
    )


def iso_text(time: Column) -> Column:
    """ISO-8601 text with offset, as event messages carry it."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def day_partitions(time: Column) -> dict[str, Column]:
    """Zero-padded year, month and day of the lake's folder layout."""
    return {
        "year": F.date_format(time, "yyyy"),
        "month": F.date_format(time, "MM"),
        "day": F.date_format(time, "dd"),
    }
