"""The star joined for reporting, one row per sale or already added up."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions import decimal_parts, exact
from tallystar.functions.keys import key_bytes
from tallystar.functions.measures import COUNT
from tallystar.plans.star import HASHED_KEYS, Star, columns_of, unit_price

# The dataset's columns, and the type of those that are widened.
DATASET_COLUMNS = (
    "sale_key", "sale_quantity", "sale_total_price", "unit_price",
    "customer_full_name", "customer_email", "customer_country",
    "product_name", "product_brand", "product_category", "product_price", "product_rating",
    "product_reviews", "supplier_name", "supplier_country",
    "store_name", "store_location", "store_city", "store_state", "store_country",
    "full_date", "month", "month_name", "year",
)
# What it reads of the fact beside its key.
DATASET_FACT = (
    "sale_quantity", "sale_total_price", "customer_key", "product_key", "store_key", "date_key",
)
WIDENED = {
    "sale_quantity": "bigint", "product_reviews": "bigint",
    "sale_total_price": "double", "unit_price": "double",
    "product_price": "double", "product_rating": "double",
}
_ATTRIBUTES = {
    "customer": ("customer_full_name", "customer_email", "customer_country"),
    "product": ("product_name", "product_brand", "product_category", "product_price",
                "product_rating", "product_reviews"),
    "supplier": ("supplier_name", "supplier_country"),
    "store": ("store_name", "store_location", "store_city", "store_state", "store_country"),
    "date": ("full_date", "month", "month_name", "year"),
}


def attach(
    df: DataFrame, star: Mapping[str, DataFrame], entity: str, *extra: str
) -> DataFrame:
    """Left join one dimension's reporting columns; rows without a match stay."""
    dimension = columns_of(star, f"dim_{entity}", *_ATTRIBUTES[entity], *extra)
    return df.join(dimension, f"{entity}_key", "left")


def products_with_suppliers(star: Mapping[str, DataFrame]) -> DataFrame:
    """The supplier is found through the product, so it joins there: the sales
    themselves are not moved for it."""
    products = columns_of(star, "dim_product", "supplier_key", *_ATTRIBUTES["product"])
    return attach(products, star, "supplier").drop("supplier_key")


def sales_dataset(star: Mapping[str, DataFrame]) -> DataFrame:
    """Every sale with its customer, product, supplier, store and date: 24 columns. Products, which
    have most columns, come after customers: theirs are not moved for another large join."""
    sales = columns_of(star, "fact_sales", *DATASET_FACT).withColumn("unit_price", unit_price())
    joined = attach(sales, star, "customer").drop("customer_key")
    joined = joined.join(products_with_suppliers(star), "product_key", "left")
    for entity in ("store", "date"):
        joined = attach(joined, star, entity)
    return joined.select(
        *(
            F.col(name).cast(WIDENED[name]).alias(name) if name in WIDENED else name
            for name in DATASET_COLUMNS
        )
    )


# Columns every report adds up. ``sales`` is the number of sales behind a row.
_SALE_SUMS = ("sales", "priced_sales", "revenue", "items")


MONEY = "decimal(22,2)"


def _product_sums(columns: list[str]) -> dict[str, Column]:
    """Product values counted once per sale, as exact decimals. Ratings that have no exact
    form with six places come as digits, to be added up for each power of ten."""
    sales, weight = F.col("sales"), F.col("sales").cast("decimal(16,0)")
    rating = F.col("product_rating").cast("double")
    placed = rating.try_cast("decimal(18,6)")
    fits = F.coalesce(placed.cast("double") == rating, F.lit(False))
    odd = rating.isNotNull() & ~fits
    digits, power = decimal_parts(F.when(odd, rating))
    price = exact(F.col("product_price"), MONEY)
    sums = {
        "product_rating": {
            "rating_sum": F.when(fits, placed * weight),
            "rating_power": power,
            "rating_digits": digits * sales.cast(COUNT),
            "rated_sales": F.when(rating.isNotNull(), sales),
            "endless_rating": F.when(odd & power.isNull(), rating),
        },
        "product_reviews": {"reviews": F.col("product_reviews") * sales},
        "product_price": {
            "price_sum": price * weight,
            "listed_sales": F.when(price.isNotNull(), sales),
        },
    }
    return {
        name: value
        for column, values in sums.items() if column in columns
        for name, value in values.items()
    }


def _weighted(df: DataFrame) -> DataFrame:
    return df.withColumns(_product_sums(df.columns))


def measures_of(dataset: DataFrame) -> DataFrame:
    """Summable columns for a dataset with a row per sale. Where a ``sale_key`` repeats, every
    row is summed and the reports count one order."""
    total = exact(F.col("sale_total_price"), MONEY)
    return _weighted(
        dataset.withColumns({
            "sales": F.lit(1).cast("bigint"),
            "priced_sales": F.when(total.isNotNull(), F.lit(1).cast("bigint")),
            "revenue": total,
            "items": F.col("sale_quantity").cast("bigint"),
        })
    )


def in_bytes(star: Mapping[str, DataFrame]) -> Star:
    """The same tables with their text keys as bytes, half as many to move and join."""

    def open_table(table: str, columns: Sequence[str] | None) -> DataFrame:
        rows = star[table] if columns is None else columns_of(star, table, *columns)
        texts = [name for name, kind in rows.dtypes if kind == "string" and name in HASHED_KEYS]
        return rows.withColumns({name: key_bytes(name) for name in texts})

    return Star(open_table)


def _add_up(df: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    return df.groupBy(key).agg(*(F.sum(name).alias(name) for name in names))


def measures_by(star: Mapping[str, DataFrame], entity: str) -> DataFrame:
    """The same columns, added up per dimension key before the dimension is joined.

    Sales are combined where they are read, so what is shuffled and joined is one
    row per key: a product, store or missing date behind a third of all sales is
    no more work than any other, and only three fact columns are scanned.
    """
    carrier = "product" if entity == "supplier" else entity
    star = in_bytes(star)
    total = F.col("sale_total_price")
    sold = columns_of(
        star, "fact_sales", f"{carrier}_key", "sale_total_price", "sale_quantity")
    added = sold.groupBy(f"{carrier}_key").agg(
        F.count("*").alias("sales"),
        F.count(total).alias("priced_sales"),
        F.sum(total).alias("revenue"),
        F.sum(F.col("sale_quantity").cast("bigint")).alias("items"),
    )
    if entity != "supplier":
        return _weighted(attach(added, star, entity))
    products = columns_of(star, "dim_product", "supplier_key", "product_price")
    by_supplier = _add_up(
        _weighted(added.join(products, "product_key", "left")),
        "supplier_key",
        (*_SALE_SUMS, "price_sum", "listed_sales"),
    )
    return attach(by_supplier, star, "supplier")
