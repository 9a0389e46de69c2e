"""Raw text to typed columns and keys."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions import (
    blank_to_null,
    date_key,
    hash_cleaned,
    to_date,
    to_decimal,
    to_double,
    to_int,
)
from tallystar.plans.columns import ENTITIES, KINDS, RENAMED, attributes_of, raw_columns_of

_CLEANERS = {
    "int": to_int, "decimal": to_decimal, "double": to_double, "date": to_date,
    "text": blank_to_null,
}

# What each key needs besides its own entity.
_NEEDS = {
    "customer": (), "seller": (), "supplier": (), "store": (),
    "product": ("supplier",),
    "sale": ("customer", "seller", "supplier", "store", "product"),
}
# The parts of a sale's key, in order.
SALE_KEY_PARTS = (
    "source_row_id", "customer_key", "seller_key", "supplier_key", "store_key", "product_key",
    "sale_date", "sale_quantity", "sale_total_price",
)
# The raw column that carries each entity's number in its source file.
SOURCE_IDS = {
    "customer": "sale_customer_id", "seller": "sale_seller_id", "product": "sale_product_id",
}


def with_needed(entities: Sequence[str]) -> tuple[str, ...]:
    """The entities asked for and those their keys are made of."""
    wanted = {*entities, *(need for entity in entities for need in _NEEDS[entity])}
    return tuple(entity for entity in ENTITIES if entity in wanted)


def clean(name: str, id_type: str = "bigint") -> Column:
    """One raw column, cleaned by its kind and under its cleaned name."""
    kind = KINDS.get(name, "text")
    cleaned = to_int(name, id_type) if kind == "id" else _CLEANERS[kind](name)
    return cleaned.alias(RENAMED.get(name, name))


def _keys(entities: Sequence[str]) -> dict[str, Column]:
    """Each entity's key. Keys made of other keys repeat their expressions, which
    Spark evaluates once; layering them would copy every wide row once per layer."""
    keys: dict[str, Column] = {}
    for entity in entities:
        if entity == "sale":
            parts = [keys.get(part, part) for part in SALE_KEY_PARTS]
        else:
            parts = [*attributes_of(entity), *(keys[f"{need}_key"] for need in _NEEDS[entity])]
        keys[f"{entity}_key"] = hash_cleaned(*parts)
    if "sale" in entities:
        keys["date_key"] = date_key("sale_date")
    return keys


def stage_copies_once(raw: DataFrame, entity: str) -> DataFrame:
    """One entity's columns and key for each of its distinct raw rows, with the smallest of
    their numbers: copies are combined where they are read, before anything else is cleaned."""
    number = SOURCE_IDS.get(entity)
    rows = raw.groupBy(*raw_columns_of(entity))
    least = [F.min(clean(number)).alias(number)] if number else []
    return stage(rows.agg(*least) if least else rows.agg(F.lit(1).alias("one")), [entity])


def stage(
    raw: DataFrame, entities: Sequence[str] = ENTITIES, id_type: str = "bigint"
) -> DataFrame:
    """Clean the columns of the entities and add their keys.

    All 50 columns and 7 keys by default; naming fewer entities keeps the plan
    small and lets the source skip the rest. ``id_type`` is the width of the four
    source numbers: ``int`` makes larger numbers null, as a 32-bit feed would.
    """
    wanted = with_needed(entities)
    names = dict.fromkeys(
        name
        for entity in wanted
        for name in (*raw_columns_of(entity), *filter(None, [SOURCE_IDS.get(entity)]))
    )
    cleaned = raw.select(*(clean(name, id_type) for name in names))
    return cleaned.withColumns(_keys(wanted))
