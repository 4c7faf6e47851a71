"""Insert-ignore: add only the rows whose key a table does not hold yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def new_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``batch`` whose key ``target`` lacks.

    Deduplicate the batch by key first: a key with very many copies would
    otherwise meet in one task of the join.
    """
    keys = list(keys)
    return batch.join(target.select(*keys), keys, "left_anti")
