"""Dense rank over a whole table without bringing it into one task."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.operators.joins import lookup
from tallystar.operators.workspace import Workspace

# monotonically_increasing_id keeps the partition number above the
# low 33 bits and the row number in them.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1

# (column, descending). Nulls are first when ascending and last when descending.
Order = Sequence[tuple[str, bool]]


def _terms(order: Order) -> list[Column]:
    return [F.desc(name) if descending else F.asc(name) for name, descending in order]


def _number(distinct: DataFrame, name: str, order: Order, work: Workspace) -> DataFrame:
    """Number the rows of a table without ties: 1, 2, 3 ... in the given order.

    A distributed sort gives every row its partition and its place there; the
    row counts of the earlier partitions complete the number. The sorted table
    is held, as both uses have to see the same partitions.
    """
    placed = work.hold(
        distinct.orderBy(*_terms(order)).withColumn("_place", F.monotonically_increasing_id()),
        name,
    ).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    # One row per partition of the sort, so small enough for one task and a broadcast.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy("_part").agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    number = F.col("_before") + F.col("_place").bitwiseAND(F.lit(_ROW_MASK)) + 1
    return (
        placed.join(F.broadcast(before), "_part")
        .withColumn(name, number.cast("bigint"))
        .drop("_part", "_place", "_before")
    )


def dense_ranks(
    df: DataFrame,
    orders: Mapping[str, Order],
    work: Workspace,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add one dense rank per name; ``source`` is a cheaper frame with the same values.

    Ranks depend only on the distinct order values, so those alone are sorted;
    rows that tie do not meet until the final join, which Spark may split or
    broadcast by measured size.
    """
    keys = list(dict.fromkeys(name for order in orders.values() for name, _ in order))
    source = df if source is None else source
    ranked = source.select(*keys).distinct()
    for name, order in orders.items():
        columns = [column for column, _ in order]
        if set(columns) == set(keys):
            ranked = _number(ranked, name, order, work)
        else:
            ranked = lookup(
                ranked, _number(source.select(*columns).distinct(), name, order, work), columns
            )
    return lookup(df, ranked, keys)
