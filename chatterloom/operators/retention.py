"""Age limits on event tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW_DAYS = 30
ENRICHED_DAYS = 90


def retain(
    df: DataFrame, days: int, *, time: str = "timestamp", as_of: datetime | None = None
) -> DataFrame:
    """Rows not older than ``days`` before ``as_of`` (default: the newest row)."""
    newest = df.agg(F.max(time)).scalar() if as_of is None else F.lit(as_of)
    return df.filter(F.col(time) >= newest - F.make_dt_interval(F.lit(days)))
