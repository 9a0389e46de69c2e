"""Null-safe lookup join."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of ``table`` (one row per key) to ``df``; null matches null."""
    renamed = table.withColumnsRenamed({key: f"_lookup_{key}" for key in keys})
    match = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_lookup_{key}")) for key in keys))
    return df.join(renamed, match, "left").drop(*(f"_lookup_{key}" for key in keys))
