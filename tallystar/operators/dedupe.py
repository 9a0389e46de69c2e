"""One row per key, always the same one."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Keep the smallest row of each key, compared by its columns from left to right.

    A grouped minimum rather than a window: copies are combined before the
    shuffle, so a key with very many copies costs one row per task.
    """
    rest = [name for name in df.columns if name != key]
    smallest = F.min(F.struct(*rest)).alias("_row")
    return df.groupBy(key).agg(smallest).select(key, *(f"_row.{name}" for name in rest))
