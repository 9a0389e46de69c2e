"""Surrogate keys."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystar.functions.clean import as_column

# Fixed value: what stands between the parts of a key before hashing.
KEY_SEPARATOR = "||"


def hash_key(*columns: str | Column) -> Column:
    """SHA-256 hex of the trimmed parts; null, blank and empty are the same part."""
    return hash_cleaned(*(F.trim(as_column(column).cast("string")) for column in columns))


def hash_cleaned(*columns: str | Column) -> Column:
    """The same key for columns that are typed or trimmed already."""
    parts = (F.coalesce(as_column(column).cast("string"), F.lit("")) for column in columns)
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def key_bytes(name: str) -> Column:
    """A key as bytes, to be moved and joined: those that a hash's text stands for, 32 instead of
    64. Any other text is its own bytes and 33 more, so that no two keys become one."""
    key = F.col(name)
    hashed = (F.length(key) == 64) & (F.lower(F.hex(F.unhex(key))) == key)
    other = F.concat(F.encode(key, "UTF-8"), F.lit(bytes(33)))
    return F.when(F.coalesce(hashed, F.lit(False)), F.unhex(key)).otherwise(other).alias(name)


def date_key(value: str | Column) -> Column:
    """``yyyyMMdd`` as an int, by arithmetic; null for no date."""
    day = as_column(value)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
