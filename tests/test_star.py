from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystar.functions import hash_key
from tallystar.plans import checks
from tallystar.plans.columns import ENTITIES, RAW_COLUMNS, attributes_of
from tallystar.plans.dataset import DATASET_COLUMNS, sales_dataset
from tallystar.plans.staging import stage
from tallystar.plans.star import (
    BUILDERS, STAR_KEYS, combined, staged_columns, star_of,
)

# The star's schema.
TYPES = {
    "dim_customer": "customer_key string, source_customer_id bigint, customer_full_name string,"
    " customer_first_name string, customer_last_name string, customer_age int,"
    " customer_email string, customer_country string, customer_postal_code string,"
    " customer_pet_type string, customer_pet_name string, customer_pet_breed string",
    "dim_seller": "seller_key string, source_seller_id bigint, seller_full_name string,"
    " seller_first_name string, seller_last_name string, seller_email string,"
    " seller_country string, seller_postal_code string",
    "dim_supplier": "supplier_key string, supplier_name string, supplier_contact string,"
    " supplier_email string, supplier_phone string, supplier_address string,"
    " supplier_city string, supplier_country string",
    "dim_store": "store_key string, store_name string, store_location string,"
    " store_city string, store_state string, store_country string, store_phone string,"
    " store_email string",
    "dim_product": "product_key string, source_product_id bigint, supplier_key string,"
    " product_name string, product_category string, product_price decimal(18,2),"
    " product_inventory_quantity int, pet_category string, product_weight decimal(18,2),"
    " product_color string, product_size string, product_brand string,"
    " product_material string, product_description string, product_rating double,"
    " product_reviews int, product_release_date date, product_expiry_date date",
    "dim_date": "date_key int, full_date date, day_of_month int, month int,"
    " month_name string, quarter int, year int",
    "fact_sales": "sale_key string, source_row_id bigint, source_customer_id bigint,"
    " source_seller_id bigint, source_product_id bigint, customer_key string,"
    " seller_key string, store_key string, product_key string, date_key int,"
    " sale_quantity int, sale_total_price decimal(18,2), unit_price decimal(19,2),"
    " loaded_at timestamp",
}


def shape(df):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def test_raw_columns():
    assert len(RAW_COLUMNS) == len(set(RAW_COLUMNS)) == 50
    assert sum(len(attributes_of(entity)) for entity in ENTITIES) == 50


def test_staging_has_every_column(raw):
    staged = stage(raw({}))
    assert len(staged.columns) == 57
    row = staged.first()
    assert row.sale_date == date(2021, 3, 5) and row.date_key == 20210305
    assert row.sale_total_price == Decimal("10.00") and row.source_row_id == 1
    assert row.store_phone is None


def test_staging_a_few_entities_equals_staging_all(raw):
    some = raw({}, {"product_price": "7"}, {"store_name": ""})
    for entity in ENTITIES:
        part = stage(some, [entity])
        whole = stage(some).select(*part.columns)
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect()))


def test_keys_are_made_of_cleaned_attributes(raw, spark):
    staged = stage(raw({"customer_email": "  ann@x ", "product_price": "5"}))
    again = staged.select(
        "customer_key", hash_key(*attributes_of("customer")).alias("c"),
        "product_key", hash_key(*attributes_of("product"), "supplier_key").alias("p"),
    ).first()
    assert again.customer_key == again.c and again.product_key == again.p


def test_row_number_width(raw):
    wide = raw({"id": "5000000000"})
    assert stage(wide).first().source_row_id == 5000000000
    assert stage(wide, id_type="int").first().source_row_id is None


@pytest.mark.parametrize("table", STAR_KEYS)
def test_schema(raw, table):
    assert shape(star_of(stage(raw({})))[table]) == TYPES[table]


def test_star_is_sound(raw):
    star = star_of(stage(raw(
        {}, {}, {"id": "2", "customer_email": ""}, {"id": "3", "sale_date": "x"},
        {"id": "4", "supplier_name": "Other"}, {"id": "5", "store_name": " "},
    )))
    assert checks.repeated_keys(star).collect() == []
    assert checks.dangling_keys(star).collect() == []
    counts = {r.table_name: r.row_count for r in checks.row_counts(star).collect()}
    assert counts == {"dim_customer": 2, "dim_seller": 1, "dim_supplier": 2, "dim_store": 2,
                      "dim_product": 2, "dim_date": 1, "fact_sales": 5}


def test_checks_find_faults(raw, spark):
    star = dict(star_of(stage(raw({}, {"id": "2"}))))
    star["dim_store"] = star["dim_store"].limit(0)
    star["dim_seller"] = star["dim_seller"].union(star["dim_seller"])
    assert [r.missing_from for r in checks.dangling_keys(star).collect()] == ["dim_store"]
    found = checks.repeated_keys(star).collect()
    assert [(r.table_name, r.row_count) for r in found] == [("dim_seller", 2)]


def test_copies_keep_the_smallest_source_numbers(raw):
    copies = [{"sale_customer_id": c, "sale_seller_id": s, "sale_product_id": p}
              for c, s, p in (("3", "1", "9"), ("2", "8", "9"), ("2", "7", "5"), ("2", "7", "4"))]
    for order in (copies, copies[::-1]):
        star = star_of(stage(raw(*order)))
        fact = star["fact_sales"].collect()
        assert [(r.source_customer_id, r.source_seller_id, r.source_product_id)
                for r in fact] == [(2, 7, 4)]
        assert [r.source_customer_id for r in star["dim_customer"].collect()] == [2]
        assert [r.source_product_id for r in star["dim_product"].collect()] == [4]


def test_attributes_that_collide_share_one_row(raw):
    """The separator is not escaped, so these two stores have one key and one row."""
    stores = [{"store_name": "a||b", "store_location": "c"},
              {"store_name": "a", "store_location": "b||c"}]
    for order in (stores, stores[::-1]):
        rows = star_of(stage(raw(*order)))["dim_store"].collect()
        assert [(r.store_name, r.store_location) for r in rows] == [("a", "b||c")]


def test_full_names_skip_missing_parts(raw):
    star = star_of(stage(raw(
        {}, {"customer_first_name": ""}, {"customer_first_name": "", "customer_last_name": ""})))
    names = {r.customer_full_name for r in star["dim_customer"].collect()}
    assert names == {"Ann Lee", "Lee", ""}


def test_dates(raw):
    star = star_of(stage(raw({"sale_date": "12/31/1999"}, {"sale_date": "12/31/1999", "id": "2"},
                             {"sale_date": ""})))
    assert [tuple(r) for r in star["dim_date"].collect()] == [
        (19991231, date(1999, 12, 31), 31, 12, "December", 4, 1999)]


def test_unit_price(raw):
    cases = [("10.00", "3"), ("10.00", "0"), ("10.00", "-1"), ("10.00", ""), ("", "3"),
             ("0.01", "2"), ("-0.01", "2")]
    star = star_of(stage(raw(*(
        {"id": str(i), "sale_total_price": t, "sale_quantity": q}
        for i, (t, q) in enumerate(cases)))))
    prices = star["fact_sales"].orderBy("source_row_id").select("unit_price").collect()
    assert [r[0] for r in prices] == [
        Decimal("3.33"), None, None, None, None, Decimal("0.01"), Decimal("-0.01")]


def test_dataset_keeps_every_sale(raw):
    star = star_of(stage(raw({}, {"id": "2", "sale_date": ""}, {"id": "3", "supplier_name": ""})))
    dataset = sales_dataset(star)
    assert tuple(dataset.columns) == DATASET_COLUMNS
    assert dataset.count() == dataset.select("sale_key").distinct().count() == 3
    assert dataset.where("full_date is null and year is null").count() == 1
    # A dimension without the row keeps the sale as well.
    lost = {**star, "dim_product": star["dim_product"].limit(0)}
    assert sales_dataset(lost).where(
        F.col("product_name").isNull() & F.col("supplier_name").isNull()).count() == 3


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_few_columns_shuffle_few(raw):
    """Readers of a few columns of a lazily built table group only those."""
    star = star_of(stage(raw({}, {}, {"sale_customer_id": "9"}, {"id": "2"})))
    sales = star.columns("fact_sales", "date_key", "sale_quantity")
    assert sales.columns == ["sale_key", "date_key", "sale_quantity"] and sales.count() == 2
    assert "SortAggregate" not in plan_of(sales)
    products = star.columns("dim_product", "product_name")
    assert products.columns == ["product_key", "product_name"] and products.count() == 1
    plan = plan_of(products)
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan
    assert "source_product_id" not in products._jdf.queryExecution().optimizedPlan().toString()
    assert star.columns("dim_customer", "customer_full_name").first()[1] == "Ann Lee"


def test_the_large_tables_are_grouped_by_hash(raw):
    star = star_of(stage(raw({}, {"sale_customer_id": "7"}, {"product_name": "a|b"})))
    for table in ("dim_product", "fact_sales"):
        plan = plan_of(star[table])
        assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_products_that_collide_share_one_row(raw):
    rows = [{"product_name": "a|", "product_category": "|b", "sale_product_id": "9"},
            {"product_name": "a", "product_category": "||b", "sale_product_id": "3"},
            {"product_name": "plain", "id": "2"}, {"product_name": "a|c", "id": "3"}]
    for order in (rows, rows[::-1]):
        star = star_of(stage(raw(*order)))
        names = sorted((r.product_name, r.source_product_id) for r in star["dim_product"].collect())
        assert names == [("a", 3), ("a|c", 1), ("plain", 1)]
        assert sorted(r.product_name for r in star.columns(
            "dim_product", "product_name").collect()) == ["a", "a|c", "plain"]


def test_numbers_of_copies_are_kept_together(raw):
    """The smallest copy, null first; beyond 42 bits each number for itself."""
    def numbers(*copies):
        names = ("sale_customer_id", "sale_seller_id", "sale_product_id")
        rows = [dict(zip(names, copy)) for copy in copies]
        (row,) = star_of(stage(raw(*rows)))["fact_sales"].collect()
        return row.source_customer_id, row.source_seller_id, row.source_product_id

    top = str(2**42 - 2)
    assert numbers(("5", "1", "1"), ("4", "9", "9")) == (4, 9, 9)
    assert numbers(("4", "", "7"), ("4", "0", "1"), ("4", "", "8")) == (4, None, 7)
    assert numbers(("", "", "")) == (None, None, None)
    assert numbers((top, top, top)) == (2**42 - 2,) * 3
    assert numbers((top, "3", top), (top, "3", "0")) == (2**42 - 2, 3, 0)
    assert numbers(("-1", "2", "9223372036854775807")) == (-1, 2, 2**63 - 1)
    assert numbers(("1", "9", "5"), ("2", "-3", "")) == (1, -3, 5)


def test_one_pass_feeds_all_tables(raw, spark):
    """A costly source is scanned once, without holding whole staged rows."""
    staged = stage(raw(
        {}, {}, {"id": "2", "sale_customer_id": "0"}, {"id": "2"}, {"id": "3", "sale_date": ""},
        {"id": "4", "store_name": "a||b", "store_location": "c"},
        {"id": "5", "store_name": "a", "store_location": "b||c"}, {"id": "6", "product_name": ""}))
    held = combined(staged)
    assert plan_of(held).count("Scan ExistingRDD") == 1
    rows = spark.createDataFrame(held.collect(), held.schema)
    assert rows.where("table = 'dim_date'").count() == 2
    whole = star_of(staged)
    for table in STAR_KEYS:
        part = rows.where(F.col("table") == table).select(*staged_columns(table))
        again = BUILDERS[table](part)
        assert again.schema == whole[table].schema, table
        shown = [sorted(map(str, df.drop("loaded_at").collect())) for df in (again, whole[table])]
        assert shown[0] == shown[1], table
