"""Text cleaning. Nothing here raises on bad text, whatever the ANSI setting."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how dates are written in the raw feed.
DATE_FORMAT = "M/d/yyyy"

# A cast from text to a whole number ignores blanks and control characters at
# both ends; the pattern below has to do the same. "$10$2" is the sign, a 0 and the digits.
_PAD = r"[\s\p{Cntrl}]*"
_FRACTION = rf"^{_PAD}([+-]?)([0-9]*)\.[0-9]*{_PAD}$"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: str | Column) -> Column:
    """Trim spaces (not tabs or newlines); nothing left means null."""
    text = F.trim(as_column(value).cast("string"))
    return F.when(text != "", text)


def to_int(value: str | Column, width: str = "int") -> Column:
    """Whole number of the given width (``int`` or ``bigint``).

    A fraction is cut off, not rounded; exponents, words and values out of
    range give null. Plain digits take the first branch, so the pattern only
    runs on the rare text that holds a decimal point. It stands in a function over an
    array, which Spark keeps out of whole-stage code: a projection with such a number runs
    as small methods. The single one that staging made was too large for the JVM to compile.
    """
    text = blank_to_null(value)
    whole = F.transform(F.array(text), lambda t: F.regexp_replace(t, _FRACTION, "$10$2"))
    return F.coalesce(text.try_cast(width), whole[0].try_cast(width))


def to_decimal(value: str | Column, precision: int = 18, scale: int = 2) -> Column:
    """Decimal, rounded half up; bad or too large text gives null."""
    return blank_to_null(value).try_cast(f"decimal({precision},{scale})")


def to_double(value: str | Column) -> Column:
    return blank_to_null(value).try_cast("double")


def to_date(value: str | Column, fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(blank_to_null(value), fmt)
