"""A raw sales feed over the driver's tables: 50 text columns with known dirt.

``oracle.RAW`` says the same in SQL; change both together.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.operators import Workspace
from tallystar.plans.columns import ENTITIES, RAW_COLUMNS, raw_columns_of
from tallystar.plans.staging import SOURCE_IDS, clean, stage, stage_copies_once, with_needed
from tallystar.plans.star import (
    BUILDERS,
    FEW_ROWS,
    HASHED_KEYS,
    Star,
    packed_keys,
    staged_columns,
    star_of,
)

# Which other tables an entity's columns come from.
_TABLES = {
    "customer": {"orders", "customer"},
    "seller": set(),
    "supplier": {"supplier"},
    "store": set(),
    "product": {"part"},
    "sale": {"orders"},
}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# Which copy of a line a row is: some lines come twice, and of others a second row gives
# the customer another number.
EXACT_COPY, RENUMBERED_COPY = 1, 2


def _lines(spark: SparkSession, folder: str, by_order: bool) -> DataFrame:
    """The line items with their copies. ``by_order`` deals them by order: the partitioning
    that a shuffled join with the orders needs anyway, so that one plan serves every size.
    Numbers are cut to what the feed shows before they are moved."""
    lines = _read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"),
    )
    copies = (
        F.when(_every("l_orderkey", 53), F.array(F.lit(0), F.lit(EXACT_COPY)))
        .when(_every("l_orderkey", 59), F.array(F.lit(0), F.lit(RENUMBERED_COPY)))
        .otherwise(F.array(F.lit(0)))
    )
    dealt = lines.repartition("l_orderkey") if by_order else lines
    return dealt.withColumn("copy", F.explode(copies))


def _text(value: Column) -> Column:
    return value.cast("string")


def _cents(name: str) -> Column:
    return _text(F.col(name).cast("decimal(18,2)"))


def _every(name: str, n: int) -> Column:
    return F.col(name) % n == 0


def _named(df: DataFrame, key: str, as_key: str, columns: dict[str, Column]) -> DataFrame:
    return df.select(
        F.col(key).alias(as_key), *(value.alias(name) for name, value in columns.items())
    )


def _where_found(found: str, columns: dict[str, Column]) -> dict[str, Column]:
    """Text made from a looked-up row; null where there was none."""
    return {name: F.when(F.col(found), value) for name, value in columns.items()}


def _nations(spark: SparkSession, folder: str, key: str, name: str) -> DataFrame:
    return _read(spark, folder, "nation").select(
        F.col("n_nationkey").alias(key), F.col("n_name").alias(name))


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    """What a customer's text is made of, narrow enough to be moved with each line."""
    return _read(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_mktsegment",
        F.lit(True).alias("c_found"))


def _customer_columns() -> dict[str, Column]:
    key = F.col("o_custkey")
    age = _text(18 + key % 60)
    return _where_found("c_found", {
        "customer_first_name": F.split_part("c_name", F.lit("#"), F.lit(1)),
        "customer_last_name": F.split_part("c_name", F.lit("#"), F.lit(2)),
        "customer_age": F.when(_every("o_custkey", 71), F.concat(age, F.lit(".9"))).otherwise(age),
        "customer_email": F.when(_every("o_custkey", 97), F.lit("   ")).otherwise(
            F.col("c_name")
        ),
        "customer_country": F.col("c_nation"),
        "customer_postal_code": _text(10000 + key % 90000),
        "customer_pet_type": F.col("c_mktsegment"),
    })


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """What an order's text is made of, as narrow."""
    return _read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
        F.col("o_orderdate").cast("date").alias("o_day"), F.lit(True).alias("o_found"))


def _order_columns() -> dict[str, Column]:
    return _where_found("o_found", {
        "sale_date": F.when(_every("l_orderkey", 83), F.lit("13/45/2021"))
        .when(_every("l_orderkey", 79), F.lit(""))
        .otherwise(F.date_format("o_day", "M/d/yyyy")),
    })


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    released = F.date_add(F.lit("1990-01-01").cast("date"), (key % 1000).cast("int"))
    return _named(_read(spark, folder, "part"), "p_partkey", "l_partkey", {
        "product_name": F.col("p_name"),
        "product_category": F.col("p_type"),
        "product_price": _cents("p_retailprice"),
        "product_quantity": _text(size * 10),
        "product_weight": _text(size),
        "product_size": _text(size),
        "product_brand": F.col("p_brand"),
        "product_rating": F.when(_every("p_partkey", 61), F.lit(" "))
        .when(key == 7, F.lit("10000000000000")).when(key == 11, F.lit("NaN"))
        .when(key == 13, F.lit("4.1234567")).otherwise(
            _text(((size % 50) / 10).cast("decimal(3,1)"))
        ),
        "product_reviews": _text(key % 1000),
        "product_release_date": F.date_format(released, "M/d/yyyy"),
        "product_expiry_date": F.date_format(F.date_add(released, 365), "M/d/yyyy"),
    })


def _suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey",
        F.lit(True).alias("s_found"))


def _supplier_columns() -> dict[str, Column]:
    return _where_found("s_found", {
        "supplier_name": F.when(_every("l_suppkey", 13), F.lit(" ")).otherwise(F.col("s_name")),
        "supplier_city": F.col("s_nation"),
        "supplier_country": F.col("s_region"),
    })


def _joined(spark: SparkSession, folder: str, tables: set[str]) -> DataFrame:
    """Line items with the tables asked for. Every join is a left lookup of a primary key, so
    leaving one out changes no other column and no row count.

    Lines are moved for orders and for parts. What is looked up before the second move stays
    as narrow as its table, and becomes text after the last one. Suppliers, nations and regions are
    looked up one by one, as whole tables that Spark knows the size of: it broadcasts them
    without moving lines, as long as they are small.
    """
    lines = _lines(spark, folder, "orders" in tables)
    if "orders" in tables:
        orders = _orders(spark, folder)
        if "customer" in tables:
            orders = orders.join(_customers(spark, folder), "o_custkey", "left")
        lines = lines.join(orders, "l_orderkey", "left")
    if "part" in tables:
        lines = lines.join(_parts(spark, folder), "l_partkey", "left")
    if "supplier" in tables:
        regions = _read(spark, folder, "region").select(
            F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("s_region"))
        places = _read(spark, folder, "nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("s_nation"),
            "n_regionkey")
        lines = lines.join(_suppliers(spark, folder), "l_suppkey", "left")
        lines = lines.join(places, "s_nationkey", "left").join(regions, "n_regionkey", "left")
    if "customer" in tables:
        lines = lines.join(_nations(spark, folder, "c_nationkey", "c_nation"), "c_nationkey", "left")
    return lines


def _line_columns() -> dict[str, Column]:
    """Columns made from the line item itself."""
    order = F.col("l_orderkey")
    seller, store = order % 50, order % 40
    brand = F.col("product_brand")
    return {
        "id": _text(order * 8 + F.col("l_linenumber")),
        "seller_first_name": F.lit("Seller"),
        "seller_last_name": _text(seller),
        "seller_country": F.concat(F.lit("Country "), _text(seller % 5)),
        "sale_customer_id": _text(
            F.col("o_custkey") + (F.col("copy") == RENUMBERED_COPY).cast("int")),
        "sale_seller_id": _text(seller),
        "sale_product_id": _text(F.col("l_partkey")),
        "sale_quantity": F.when(_every("l_orderkey", 101), F.lit("0"))
        .when(_every("l_orderkey", 103), F.lit(" "))
        .otherwise(_text(F.col("l_quantity"))),
        "sale_total_price": F.when(_every("l_orderkey", 89), F.lit("n/a")).otherwise(
            _text(F.col("l_extendedprice"))
        ),
        "store_name": F.concat(F.lit("Store "), _text(store)),
        "store_location": F.concat(F.lit("L"), _text(store % 10)),
        "store_city": F.concat(F.lit("City "), _text(store % 20)),
        "store_country": F.concat(F.lit("Country "), _text(store % 8)),
        # Brands come padded on some lines, so that only trimmed text groups well.
        "product_brand": F.when(
            F.col("l_linenumber") == 3, F.concat(F.lit(" "), brand, F.lit("  "))
        ).otherwise(brand),
    }


def raw_sales(
    spark: SparkSession, folder: str, entities: Sequence[str] = ENTITIES
) -> DataFrame:
    """The feed, or only the columns of some entities and the tables those need."""
    wanted = with_needed(entities)
    tables = set().union(*(_TABLES[entity] for entity in wanted))
    named = {name for entity in wanted for name in raw_columns_of(entity)}
    named.update(SOURCE_IDS[entity] for entity in wanted if entity in SOURCE_IDS)
    joined, made = _joined(spark, folder, tables), _line_columns()
    looked_up = {name: F.col(name) for name in joined.columns}
    columns = {**looked_up, **made}
    if "orders" in tables:
        columns.update(_order_columns())
    if "customer" in tables:
        columns.update(_customer_columns())
    if "supplier" in tables:
        columns.update(_supplier_columns())
    return joined.select(
        *(columns.get(name, F.lit("")).alias(name) for name in RAW_COLUMNS if name in named)
    )


def staged_sales(
    spark: SparkSession, folder: str, entities: Sequence[str] = ENTITIES
) -> DataFrame:
    return stage(raw_sales(spark, folder, entities), entities)


def _dates(spark: SparkSession, folder: str) -> DataFrame:
    """Only the sale dates, cleaned."""
    dates = _order_columns()["sale_date"].alias("sale_date")
    return _joined(spark, folder, {"orders"}).select(dates).select(clean("sale_date"))


# The entity whose columns each star table is made of.
_ENTITY_OF = {
    "dim_customer": "customer", "dim_seller": "seller", "dim_supplier": "supplier",
    "dim_store": "store", "dim_product": "product", "fact_sales": "sale",
}


# How much of a key's 256 bits is held where a key is not shown.
HELD_BITS = 128


def feed_star(spark: SparkSession, folder: str, packed: bool = False,
              halved: Sequence[str] = ()) -> Star:
    """The star over the feed, each table from only the columns it needs. ``packed`` keeps its
    keys as bytes, for joins that move them; ``shown_keys`` makes them text. Of ``halved`` ones,
    which are not shown, the first ``HELD_BITS`` are kept."""
    whole = [key for key in HASHED_KEYS if key not in halved]

    def open_table(table: str, columns: Sequence[str] | None) -> DataFrame:
        if table == "dim_date":
            staged = _dates(spark, folder)
        elif table in FEW_ROWS:
            entity = _ENTITY_OF[table]
            staged = stage_copies_once(raw_sales(spark, folder, [entity]), entity)
        else:
            staged = staged_sales(spark, folder, [_ENTITY_OF[table]])
        return BUILDERS[table](
            packed_keys(staged, HELD_BITS, whole) if packed else staged, columns)

    return Star(open_table)


def held_star(
    spark: SparkSession, folder: str, work: Workspace, tables: Sequence[str],
    fact_columns: Sequence[str] | None = None, whole: Sequence[str] = (),
) -> Star:
    """The star over the feed cleaned once: the columns of the named tables are staged and
    held, and every table is built from there. Hashed keys are held and compared by their first
    ``HELD_BITS``: they only tell rows apart, no report shows them. That two of 224 million keys
    agree so far has a chance of 7e-23. ``fact_columns`` are those read of the fact beside its
    key, all by default. Keys that are shown are held ``whole``, as bytes.
    """
    staged = staged_sales(spark, folder)
    columns = dict.fromkeys(
        name for table in tables
        for name in (("sale_key", *fact_columns) if table == "fact_sales" and fact_columns
                     else staged_columns(table))
        if name in staged.columns)
    held = packed_keys(staged.select(*columns), HELD_BITS, whole)
    return star_of(work.hold(held, "staged"))
