"""Totals of a group shown on each of its rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tallystar.operators.joins import lookup


def with_totals(
    df: DataFrame, keys: Sequence[str], onto: DataFrame | None = None, **totals: Column
) -> DataFrame:
    """Add one total per name, taken over the rows of ``df`` that share ``keys``.

    The same result as an unordered window, but rows are combined before the
    shuffle and joined back, so a country or category that holds a third of all
    rows is never brought into one task. ``df`` is read twice: hold it first, and pass
    what was already added to it as ``onto``.
    """
    table = df.groupBy(*keys).agg(*(total.alias(name) for name, total in totals.items()))
    return lookup(df if onto is None else onto, table, keys)
