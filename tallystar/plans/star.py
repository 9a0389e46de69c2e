"""Staging to six dimensions and one fact."""
from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import cache, reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions import date_key
from tallystar.functions.keys import KEY_SEPARATOR
from tallystar.operators import Workspace, one_row_per_key, run_workspace
from tallystar.plans.columns import KINDS, attributes_of
from tallystar.plans.staging import SOURCE_IDS
from tallystar.sources.jdbc import HexSplit

# The table names and the column each is unique on.
STAR_KEYS = {
    "dim_customer": "customer_key",
    "dim_seller": "seller_key",
    "dim_supplier": "supplier_key",
    "dim_store": "store_key",
    "dim_product": "product_key",
    "dim_date": "date_key",
    "fact_sales": "sale_key",
}

# Keys that are hashes: text in hex, or the bytes it stands for.
HASHED_KEYS = (*(key for key in STAR_KEYS.values() if key != "date_key"),)


def _packed(staged: DataFrame, *names: str) -> list[Column]:
    """Columns with keys as bytes, half as long as their text, to be moved and grouped."""
    texts = {name for name, kind in staged.dtypes if kind == "string" and name in HASHED_KEYS}
    return [F.unhex(name).alias(name) if name in texts else F.col(name) for name in names]


def _unpacked(staged: DataFrame, *names: str) -> list[Column]:
    """The same columns again as they were in ``staged``."""
    texts = {name for name, kind in staged.dtypes if kind == "string" and name in HASHED_KEYS}
    return [F.lower(F.hex(name)).alias(name) if name in texts else F.col(name) for name in names]


def packed_keys(staged: DataFrame, bits: int = 256, whole: Sequence[str] = ()) -> DataFrame:
    """Hashed keys as bytes, the first ``bits`` of all but the ``whole`` ones."""
    return staged.withColumns({
        name: F.unhex(name if name in whole or bits == 256 else F.substring(name, 1, bits // 4))
        for name in HASHED_KEYS if name in staged.columns})


def shown_keys(df: DataFrame) -> DataFrame:
    """Keys in bytes as the text they are shown as."""
    return df.withColumns({
        name: F.lower(F.hex(name)) for name in HASHED_KEYS if name in df.columns})


def key_splits(parts: int) -> dict[str, HexSplit]:
    """Even parallel JDBC scans for the tables keyed by a hash."""
    return {
        table: HexSplit(key, parts) for table, key in STAR_KEYS.items() if key != "date_key"
    }


def _shown(dimension: DataFrame, entity: str, columns: Sequence[str] | None) -> DataFrame:
    return dimension if columns is None else dimension.select(f"{entity}_key", *columns)


def _dimension(staged: DataFrame, entity: str, *determined: str) -> DataFrame:
    """One row per key of an entity without a number in its source file.

    ``determined`` are further columns the key is made of. The first grouping combines
    copies by hash where they are read; the second settles the few rows that share a
    key all the same.
    """
    key = f"{entity}_key"
    rows = staged.select(key, *determined, *attributes_of(entity)).distinct()
    return one_row_per_key(rows, key)


def _numbered_dimension(staged: DataFrame, entity: str, *determined: str) -> DataFrame:
    """The same with the smallest source number of each key."""
    key, number = f"{entity}_key", f"source_{entity}_id"
    columns = (*determined, *attributes_of(entity))
    rows = staged.groupBy(key, *columns).agg(F.min(number).alias(number))
    return one_row_per_key(rows.select(key, number, *columns), key)


def _with_full_name(dimension: DataFrame, entity: str) -> DataFrame:
    """First and last name in one column; missing parts leave no gap."""
    name = F.concat_ws(" ", f"{entity}_first_name", f"{entity}_last_name")
    return dimension.select(
        f"{entity}_key", f"source_{entity}_id", name.alias(f"{entity}_full_name"),
        *attributes_of(entity),
    )


def dim_customer(staged: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    named = _with_full_name(_numbered_dimension(staged, "customer"), "customer")
    return _shown(named, "customer", columns)


def dim_seller(staged: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    named = _with_full_name(_numbered_dimension(staged, "seller"), "seller")
    return _shown(named, "seller", columns)


def dim_supplier(staged: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _shown(_dimension(staged, "supplier"), "supplier", columns)


def dim_store(staged: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _shown(_dimension(staged, "store"), "store", columns)


def _holds_separator(entity: str) -> Column:
    """Rows of which another one can have the same key and yet be different: parts of a key
    are joined by a separator that texts are free to hold. Without any of its characters in
    a text, the key tells all of them."""
    texts = [name for name in attributes_of(entity) if KINDS.get(name, "text") == "text"]
    return reduce(or_, (
        F.coalesce(F.contains(name, F.lit(KEY_SEPARATOR[0])), F.lit(False)) for name in texts))


def dim_product(staged: DataFrame, columns: Sequence[str] | None = None,
                work: Workspace | None = None) -> DataFrame:
    """One row per product, of which there are nearly as many as sales.

    Rows whose key tells all their columns are settled by one grouping by hash, which moves
    only the columns wanted. The others, if there are any, are settled first and held by
    ``work`` (by default in the run folder).
    """
    if columns is None:
        columns = ("source_product_id", "supplier_key", *attributes_of("product"))
    doubtful = _holds_separator("product")
    work = work or run_workspace(staged.sparkSession)
    few = work.hold(
        _numbered_dimension(staged.where(doubtful), "product", "supplier_key"), "products")
    clear = few.isEmpty()
    number = [name for name in columns if name == "source_product_id"]
    rows = (staged if clear else staged.where(~doubtful)).groupBy(
        *_packed(staged, "product_key", *(name for name in columns if name not in number)))
    settled = (rows.agg(*(F.min(name).alias(name) for name in number)) if number
               else rows.agg(F.lit(1).alias("one")))
    settled = settled.select(*_unpacked(staged, "product_key", *columns))
    return settled if clear else settled.unionByName(few.select("product_key", *columns))


def dim_date(staged: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The dates that occur. The calendar parts are worked out once per date."""
    day = F.col("full_date")
    days = staged.select(F.col("sale_date").alias("full_date")).where(day.isNotNull())
    return days.distinct().select(
        date_key(day).alias("date_key"),
        "full_date",
        F.dayofmonth(day).alias("day_of_month"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
    )


def unit_price() -> Column:
    """Price of one piece, rounded half up to cents; null unless the quantity is positive."""
    each = F.try_divide("sale_total_price", "sale_quantity")
    return F.round(F.when(F.col("sale_quantity") > 0, each), 2)


# What a sale's key is made of, or follows from it: equal on all copies of a sale.
SETTLED = (
    "source_row_id", "customer_key", "seller_key", "store_key", "product_key", "date_key",
    "sale_quantity", "sale_total_price",
)
_NUMBERS = ("source_customer_id", "source_seller_id", "source_product_id")


def settled_sales(staged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per sale with some of its ``SETTLED`` columns, which alone are moved."""
    rows = staged.select(*_packed(staged, "sale_key", *columns)).distinct()
    return rows.select(*_unpacked(staged, "sale_key", *columns))


# Source numbers are compared together as one decimal of 38 digits: three of 42 bits. One more
# than the number, as 0 stands for null.
_BITS = 42
_MOST = (1 << _BITS) - 2


def _packed_numbers() -> Column:
    """The three numbers, in order, as one; null if one of them is too large or negative."""
    parts = [F.coalesce(F.col(name) + 1, F.lit(0)).cast("decimal(13,0)") for name in _NUMBERS]
    steps = [F.lit(str(1 << _BITS * (2 - i))).cast(f"decimal({(26, 13, 1)[i]},0)")
             for i in range(3)]
    packed = reduce(add, (
        (part * step).cast("decimal(38,0)") for part, step in zip(parts, steps, strict=True)))
    return F.when(~_too_large(), packed.cast("decimal(38,0)"))


def _too_large() -> Column:
    return reduce(or_, (~F.coalesce(F.col(name), F.lit(0)).between(0, _MOST) for name in _NUMBERS))


def _unpacked_number(place: int) -> Column:
    """One of the three again."""
    above, own = (F.lit(str(1 << _BITS * k)).cast("decimal(38,0)") for k in (3 - place, 2 - place))
    rest = F.col("packed") if place == 0 else F.col("packed") % above
    number = F.call_function("div", rest, own).cast("bigint")
    return F.nullif(number, F.lit(0)) - 1


def fact_sales(staged: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per sale.

    The sale key is made of values that hold no separator, so it settles every column but
    the three source numbers; those are kept together as the smallest of the copies. One
    grouping by hash does it, with one exchange: copies are combined before it, and the
    numbers are compared as one packed decimal, which is taken apart again only where it is not
    made of the smallest of each. Where a number is negative or above 2 ** 42 each is the
    smallest for itself.
    """
    if columns is not None and not {*columns} & {*_NUMBERS, "unit_price", "loaded_at"}:
        return settled_sales(staged, columns)
    grouped = staged.groupBy(*_packed(staged, "sale_key", *SETTLED)).agg(
        F.min(_packed_numbers()).alias("packed"), F.max(_too_large()).alias("too_large"),
        *(F.min(name).alias(name) for name in _NUMBERS))
    each = F.col("too_large") | (F.col("packed") == _packed_numbers())
    numbers = [F.when(each, F.col(name)).otherwise(_unpacked_number(i)).alias(name)
               for i, name in enumerate(_NUMBERS)]
    sales = grouped.select(
        *_unpacked(staged, "sale_key", "source_row_id"), *numbers,
        *_unpacked(staged, *SETTLED[1:]),
        unit_price().alias("unit_price"), F.current_timestamp().alias("loaded_at"),
    )
    return sales if columns is None else sales.select("sale_key", *columns)


# Dimensions with few rows beside the sales, made of one entity each.
FEW_ROWS = ("dim_customer", "dim_seller", "dim_supplier", "dim_store")

# Each takes staging and, optionally, the columns wanted beside the key. Those in ``HOLDING``
# also take a workspace.
HOLDING = ("dim_product",)
BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "dim_customer": dim_customer,
    "dim_seller": dim_seller,
    "dim_supplier": dim_supplier,
    "dim_store": dim_store,
    "dim_product": dim_product,
    "dim_date": dim_date,
    "fact_sales": fact_sales,
}


def staged_columns(table: str) -> tuple[str, ...]:
    """The staged columns that a table is built from."""
    if table == "dim_date":
        return ("sale_date",)
    if table == "fact_sales":
        return ("sale_key", *SETTLED, *_NUMBERS)
    entity = table.removeprefix("dim_")
    numbers = [name for name in _NUMBERS if name == f"source_{entity}_id"]
    determined = ("supplier_key",) if entity == "product" else ()
    return (f"{entity}_key", *numbers, *determined, *attributes_of(entity))


class Star(Mapping):
    """The seven tables by name, each opened when first asked for.

    ``open_table`` takes a table's name and the columns wanted beside its key, or none for
    all of them: a table that is built when read then moves no others.
    """

    def __init__(self, open_table: Callable[[str, Sequence[str] | None], DataFrame]):
        self._open, self._whole = open_table, cache(lambda table: open_table(table, None))

    def __getitem__(self, table: str) -> DataFrame:
        if table not in BUILDERS:
            raise KeyError(table)
        return self._whole(table)

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)

    def columns(self, table: str, *columns: str) -> DataFrame:
        """The key of a table and some of its columns."""
        return self._open(table, columns).select(STAR_KEYS[table], *columns)


def columns_of(star: Mapping[str, DataFrame], table: str, *columns: str) -> DataFrame:
    """The same of any mapping of tables."""
    if isinstance(star, Star):
        return star.columns(table, *columns)
    return star[table].select(STAR_KEYS[table], *columns)


def star_of(staged: DataFrame) -> Star:
    return Star(lambda table, columns: BUILDERS[table](staged, columns))


def combined(staged: DataFrame) -> DataFrame:
    """What all seven tables are built from, in one pass over staging: for each ``table`` the
    distinct rows of its columns, others null. Copies are combined where they are read.
    """
    whole = {table: staged_columns(table) for table in BUILDERS}
    numbers = {f"dim_{entity}": f"source_{entity}_id" for entity in SOURCE_IDS}
    # The smallest number of a dimension's rows is an aggregate, not part of its group.
    sets = {table: [c for c in columns if c != numbers.get(table)]
            for table, columns in whole.items()}
    every = list(dict.fromkeys(c for columns in sets.values() for c in columns))
    masks = {sum((c not in columns) << (len(every) - 1 - i) for i, c in enumerate(every)): table
             for table, columns in sets.items()}
    which = F.create_map(*(F.lit(x) for pair in masks.items() for x in pair))
    grouped = staged.groupingSets(list(sets.values()), *every).agg(
        which[F.grouping_id()].alias("table"),
        *(F.min(name).alias(f"least_{name}") for name in numbers.values()))
    return grouped.select(
        "table", *(c for c in every if c not in numbers.values()),
        *(F.when(F.col("table") == "fact_sales", F.col(name)).when(
            F.col("table") == table, F.col(f"least_{name}")).alias(name)
          for table, name in numbers.items()))
