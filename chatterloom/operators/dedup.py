"""One row per event, and the report of what was removed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterloom.operators.ranking import first_per_group


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = ("event_id",),
    newest_first: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """The latest row per key.

    Copies that agree in ``newest_first`` are ordered by their remaining
    columns, largest first, so the survivor never depends on row order. Select
    the columns you need before this call: all of them take part in the
    shuffle. Copies of one key are thinned before the shuffle, so a key with
    very many copies costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_first]
    order = [F.desc_nulls_last(c) for c in (*newest_first, *rest)]
    return first_per_group(df, list(keys), order, 1)


def dedup_report(df: DataFrame, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """Rows before and after deduplication and rows removed, in one scan."""
    copies = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
        (F.coalesce(F.sum("copies"), F.lit(0)) - F.count("*")).alias("rows_removed"),
    )
