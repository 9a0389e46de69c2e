"""The six reports.

Each takes sales as ``measures_by`` gives them (added up per dimension key) or
as ``measures_of`` does (one row per sale); the results are equal. Orders are distinct
sale keys: the fact holds each once, so there they are the number of sales.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions import hash_key, mean_in_cents, sum_of_parts
from tallystar.operators import Workspace, dense_ranks, with_totals
from tallystar.operators.joins import lookup
from tallystar.plans.dataset import measures_by

PRODUCT_GRAIN = ("product_name", "product_brand", "product_category")
CUSTOMER_GRAIN = ("customer_email", "customer_full_name", "customer_country")
PERIOD_GRAIN = ("year", "month", "month_name")
STORE_GRAIN = ("store_name", "store_location", "store_city", "store_state", "store_country")
SUPPLIER_GRAIN = ("supplier_name", "supplier_country")

# How far down a ranking the flags reach.
TOP_PRODUCTS, TOP_CUSTOMERS, TOP_STORES, TOP_SUPPLIERS = 10, 10, 5, 5

DESCENDING, ASCENDING = True, False


def add_up(rows: DataFrame, grain: tuple[str, ...], /, **measures: Column) -> DataFrame:
    """One row per group, with revenue as an exact decimal."""
    return rows.groupBy(*grain).agg(
        *(measure.alias(name) for name, measure in measures.items())
    )


def _mean(total: str, count: str) -> Column:
    return mean_in_cents(F.sum(total), F.sum(count))


def _mean_rating() -> Column:
    """Exact where all ratings of a group are; otherwise the mean of all, added up by powers
    of ten, so that no rating is left out however large or long, and no order of rows
    changes it. NaN, or both infinities, give NaN."""
    total = sum_of_parts(F.col("rating_parts")) + F.coalesce(
        F.col("rating_sum").cast("double"), F.lit(0.0))
    least, most = F.col("least_endless"), F.col("most_endless")
    endless = F.when(least == most, least).otherwise(F.lit(float("nan")))
    return (
        F.when(most.isNotNull(), endless)
        .when(F.size("rating_parts") > 0, F.round(total / F.col("rated_sales"), 2))
        .otherwise(mean_in_cents(F.col("rating_sum"), F.col("rated_sales"))))


def _orders(sales: DataFrame) -> Column:
    """Distinct sales; for sales already added up by a key of the fact, their number."""
    return F.count_distinct("sale_key") if "sale_key" in sales.columns else F.sum("sales")


def money(name: str) -> Column:
    """Sums stay exact until here; reports show money as a double."""
    return F.col(name).cast("double").alias(name)


def product_groups(sales: DataFrame) -> DataFrame:
    """What the product and the quality report share.

    Groups are first added up by the power of ten of odd ratings as well; ordinary ones
    have none.
    """
    orders = None
    if "sale_key" in sales.columns:
        orders = sales.groupBy(*PRODUCT_GRAIN).agg(_orders(sales).alias("order_count"))
    by_power = add_up(
        sales, (*PRODUCT_GRAIN, "rating_power"),
        **{name: F.sum(name) for name in (
            "sales", "revenue", "items", "reviews", "rating_sum", "rated_sales", "rating_digits")},
        least_endless=F.min("endless_rating"), most_endless=F.max("endless_rating"))
    groups = add_up(
        by_power, PRODUCT_GRAIN,
        total_revenue=F.sum("revenue"), total_sales_quantity=F.sum("items"),
        order_count=F.sum("sales"), total_reviews=F.sum("reviews"),
        rating_sum=F.sum("rating_sum"), rated_sales=F.sum("rated_sales"),
        least_endless=F.min("least_endless"), most_endless=F.max("most_endless"),
        # One for each power that occurs, at most a few hundred.
        rating_parts=F.collect_list(F.when(F.col("rating_power").isNotNull(), F.struct(
            F.col("rating_power").alias("power"), F.col("rating_digits").alias("digits")))))
    if orders is not None:
        groups = lookup(groups.drop("order_count"), orders, PRODUCT_GRAIN)
    return groups.select(
        *PRODUCT_GRAIN, "total_revenue", "total_sales_quantity", "order_count",
        _mean_rating().alias("avg_rating"), "total_reviews")


def product_sales(groups: DataFrame, work: Workspace) -> DataFrame:
    """Report over ``product_groups``, which is read several times."""
    shared = with_totals(
        groups, ["product_category"], category_revenue=F.sum("total_revenue")
    )
    ranked = dense_ranks(
        shared,
        {"sales_rank": [("total_sales_quantity", DESCENDING), ("total_revenue", DESCENDING)]},
        work,
        source=groups,
    )
    return ranked.select(
        hash_key(*PRODUCT_GRAIN).alias("product_group_key"),
        *PRODUCT_GRAIN,
        money("total_revenue"),
        "total_sales_quantity",
        "order_count",
        "avg_rating",
        "total_reviews",
        money("category_revenue"),
        "sales_rank",
        (F.col("sales_rank") <= TOP_PRODUCTS).alias("is_top_10_product"),
    )


def customer_groups(sales: DataFrame) -> DataFrame:
    return add_up(
        sales, CUSTOMER_GRAIN,
        total_spent=F.sum("revenue"),
        order_count=_orders(sales),
        avg_check=_mean("revenue", "priced_sales"),
        total_items=F.sum("items"),
    )


def customer_sales(groups: DataFrame, work: Workspace) -> DataFrame:
    """The key is made of the email alone, so it can repeat; rows without an email
    are listed but not counted in their country."""
    counted = with_totals(
        groups, ["customer_country"], country_customer_count=F.count("customer_email")
    )
    ranked = dense_ranks(
        counted,
        {"customer_rank": [("total_spent", DESCENDING), ("order_count", DESCENDING)]},
        work,
        source=groups,
    )
    return ranked.select(
        hash_key("customer_email").alias("customer_key"),
        "customer_full_name",
        "customer_email",
        "customer_country",
        money("total_spent"),
        "order_count",
        "avg_check",
        "total_items",
        "country_customer_count",
        "customer_rank",
        (F.col("customer_rank") <= TOP_CUSTOMERS).alias("is_top_10_customer"),
    )


def period_groups(sales: DataFrame) -> DataFrame:
    return add_up(
        sales, PERIOD_GRAIN,
        total_revenue=F.sum("revenue"),
        order_count=_orders(sales),
        avg_order_size=_mean("revenue", "priced_sales"),
        total_items=F.sum("items"),
    )


def time_sales(groups: DataFrame, work: Workspace | None = None) -> DataFrame:
    """One row per month that has sales, and one for sales without a date.

    The calendar bounds the number of months, so ordinary windows do: one task
    sees at most twelve rows for each of 9,999 years.
    """
    in_order = Window.orderBy("year", "month")
    now, before = F.col("total_revenue"), F.col("previous_period_revenue")
    growth = F.try_divide(
        now.cast("double") - before.cast("double"), before.cast("double")
    ) * 100
    return (
        groups.withColumns({
            "year_total_revenue": F.sum("total_revenue").over(Window.partitionBy("year")),
            "previous_period_revenue": F.coalesce(
                F.lag("total_revenue").over(in_order), F.lit(0).cast("decimal(18,2)")
            ),
        })
        .select(
            *PERIOD_GRAIN,
            F.format_string("%04d-%02d", "year", "month").alias("year_month"),
            money("total_revenue"),
            money("year_total_revenue"),
            "order_count",
            "avg_order_size",
            "total_items",
            money("previous_period_revenue"),
            (now - before).cast("double").alias("revenue_diff_prev_period"),
            F.round(F.when(before == 0, F.lit(0.0)).otherwise(growth), 2)
            .alias("revenue_growth_pct"),
        )
    )


def store_groups(sales: DataFrame) -> DataFrame:
    return add_up(
        sales, STORE_GRAIN,
        total_revenue=F.sum("revenue"),
        order_count=_orders(sales),
        avg_check=_mean("revenue", "priced_sales"),
        total_items=F.sum("items"),
    )


def store_sales(groups: DataFrame, work: Workspace) -> DataFrame:
    by_city = with_totals(
        groups, ["store_city", "store_country"], city_revenue=F.sum("total_revenue")
    )
    by_country = with_totals(
        groups, ["store_country"], onto=by_city, country_revenue=F.sum("total_revenue")
    )
    ranked = dense_ranks(
        by_country,
        {"store_rank": [("total_revenue", DESCENDING), ("order_count", DESCENDING)]},
        work,
        source=groups,
    )
    return ranked.select(
        hash_key(*STORE_GRAIN).alias("store_key"),
        *STORE_GRAIN,
        money("total_revenue"),
        "order_count",
        "avg_check",
        "total_items",
        money("city_revenue"),
        money("country_revenue"),
        "store_rank",
        (F.col("store_rank") <= TOP_STORES).alias("is_top_5_store"),
    )


def supplier_groups(sales: DataFrame) -> DataFrame:
    return add_up(
        sales, SUPPLIER_GRAIN,
        total_revenue=F.sum("revenue"),
        avg_product_price=_mean("price_sum", "listed_sales"),
        order_count=_orders(sales),
        total_items=F.sum("items"),
    )


def supplier_sales(groups: DataFrame, work: Workspace) -> DataFrame:
    by_country = with_totals(
        groups,
        ["supplier_country"],
        country_revenue=F.sum("total_revenue"),
        country_supplier_count=F.count("supplier_name"),
    )
    ranked = dense_ranks(
        by_country,
        {"supplier_rank": [("total_revenue", DESCENDING), ("order_count", DESCENDING)]},
        work,
        source=groups,
    )
    return ranked.select(
        hash_key(*SUPPLIER_GRAIN).alias("supplier_key"),
        *SUPPLIER_GRAIN,
        money("total_revenue"),
        "avg_product_price",
        "order_count",
        "total_items",
        money("country_revenue"),
        "country_supplier_count",
        "supplier_rank",
        (F.col("supplier_rank") <= TOP_SUPPLIERS).alias("is_top_5_supplier"),
    )


def rating_correlation(groups: DataFrame) -> DataFrame:
    """Pearson correlation of rating and quantity, one row; null if either is constant.

    ``corr`` raises on constant input under ANSI rules, so it is taken apart here.
    """
    rating, quantity = F.col("avg_rating"), F.col("total_sales_quantity").cast("double")
    spread = F.stddev_pop(rating) * F.stddev_pop(quantity)
    varies = (F.min(rating) < F.max(rating)) & (F.min(quantity) < F.max(quantity))
    correlation = F.when(varies, F.try_divide(F.covar_pop(rating, quantity), spread))
    return groups.where(rating.isNotNull() & quantity.isNotNull()).agg(
        F.round(correlation, 4).alias("sales_rating_correlation")
    )


def product_quality(groups: DataFrame, work: Workspace) -> DataFrame:
    """Products without a rating rank lowest: nulls come first when ascending."""
    ranked = dense_ranks(
        groups,
        {
            "highest_rating_rank": [("avg_rating", DESCENDING), ("total_reviews", DESCENDING)],
            "lowest_rating_rank": [("avg_rating", ASCENDING), ("total_reviews", DESCENDING)],
            "reviews_rank": [("total_reviews", DESCENDING)],
        },
        work,
    )
    return ranked.select(
        hash_key(*PRODUCT_GRAIN).alias("product_group_key"),
        *PRODUCT_GRAIN,
        "avg_rating",
        "total_reviews",
        "total_sales_quantity",
        money("total_revenue"),
        rating_correlation(groups).scalar().alias("sales_rating_correlation"),
        "highest_rating_rank",
        "lowest_rating_rank",
        "reviews_rank",
        (F.col("highest_rating_rank") == 1).alias("is_highest_rated"),
        (F.col("lowest_rating_rank") == 1).alias("is_lowest_rated"),
        (F.col("reviews_rank") == 1).alias("has_most_reviews"),
    )


@dataclass(frozen=True)
class Mart:
    entity: str
    groups: Callable[[DataFrame], DataFrame]
    report: Callable[[DataFrame, Workspace], DataFrame]
    # Storage order: the declared key, then columns that spread a repeated key.
    order: tuple[str, ...]


# The names of the report tables and the key each is stored by.
MARTS = {
    "report_sales_products": Mart(
        "product", product_groups, product_sales, ("product_group_key",)),
    "report_sales_customers": Mart(
        "customer", customer_groups, customer_sales,
        ("customer_key", "customer_full_name", "customer_country")),
    "report_sales_time": Mart(
        "date", period_groups, time_sales, ("year", "month")),
    "report_sales_stores": Mart(
        "store", store_groups, store_sales, ("store_key",)),
    "report_sales_suppliers": Mart(
        "supplier", supplier_groups, supplier_sales, ("supplier_key",)),
    "report_product_quality": Mart(
        "product", product_groups, product_quality, ("product_group_key",)),
}


def mart(name: str, star: Mapping[str, DataFrame], work: Workspace) -> DataFrame:
    """One report straight from the star."""
    chosen = MARTS[name]
    groups = work.hold(chosen.groups(measures_by(star, chosen.entity)), name)
    return chosen.report(groups, work)
