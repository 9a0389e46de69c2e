"""Exact sums and averages."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(value: Column, kind: str) -> Column:
    """``value`` as a decimal type. A value that does not fit, NaN included, stops the query
    under either ANSI setting rather than leaving the sums."""
    fitted = value.try_cast(kind)
    lost = value.isNotNull() & fitted.isNull()
    message = F.concat(F.lit(f"does not fit {kind}: "), value.cast("string"))
    return F.when(lost, F.raise_error(message).cast(kind)).otherwise(fitted)


def mean_in_cents(total: Column, count: Column) -> Column:
    """``total / count`` rounded half up to two places, as a double.

    ``total`` is an exact decimal with at most six places. Whole-number
    division of doubled cents never rounds twice, so the result does not
    depend on the number of rows or on the order they were added in.
    """
    doubled = F.abs(total) * 200 + count
    cents = F.call_function("div", doubled, F.nullif(count, F.lit(0)) * 2)
    return F.signum(total) * cents / 100


# Wide enough for a double's digits, and together with a count for a product of 38 digits.
DIGITS, COUNT = "decimal(25,18)", "decimal(12,0)"


def decimal_parts(value: Column) -> tuple[Column, Column]:
    """The digits of a double's shortest decimal form and the power of ten they are taken
    by; null digits for NaN and infinities. Digits of one power add up exactly."""
    text = value.cast("string")
    power = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int"))
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    digits = F.when(finite, F.substring_index(text, "E", 1)).cast(DIGITS)
    return digits, F.when(finite, F.coalesce(power, F.lit(0)))


def sum_of_parts(parts: Column) -> Column:
    """The sum, as a double, of structs of a power and the exact sum of its digits: one
    addition for each power, the largest first, so the order of the rows does not count."""
    return F.aggregate(
        F.sort_array(parts, asc=False), F.lit(0.0),
        lambda total, part: total + part["digits"].cast("double") * F.pow(
            F.lit(10.0), part["power"].cast("double")))
