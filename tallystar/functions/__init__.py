"""Column expressions: cleaning, keys, null filling and exact measures."""
from tallystar.functions.clean import (
    as_column,
    blank_to_null,
    to_date,
    to_decimal,
    to_double,
    to_int,
)
from tallystar.functions.keys import date_key, hash_cleaned, hash_key
from tallystar.functions.measures import decimal_parts, exact, mean_in_cents, sum_of_parts
from tallystar.functions.nulls import null_fill

__all__ = [
    "as_column", "blank_to_null", "date_key", "decimal_parts", "exact", "hash_cleaned", "hash_key",
    "mean_in_cents", "null_fill", "sum_of_parts", "to_date", "to_decimal", "to_double", "to_int",
]
