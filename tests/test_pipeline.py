import csv
import os

import pytest
from pyspark.errors import PySparkException

from tallystar.operators.workspace import run_folder
from tallystar.plans.columns import RAW_COLUMNS
from tallystar.plans.dataset import measures_by
from tallystar.plans.marts import MARTS
from tallystar.plans.pipeline import (
    RAW_TABLE,
    build_marts,
    build_star,
    ingest_raw,
    run_all,
    star_in,
)
from tallystar.plans.star import STAR_KEYS, key_splits
from tallystar.sources import CatalogStore, FolderStore, PublishedStore


@pytest.fixture
def stores(spark, tmp_path):
    return FolderStore(spark, f"{tmp_path}/star"), FolderStore(spark, f"{tmp_path}/marts")


def rows_of(store, tables):
    return {t: sorted(map(str, store.read(t).drop("loaded_at").collect())) for t in tables}


def write_csv(folder, rows):
    for part in range(2):
        with open(folder / f"part_{part}.csv", "w", newline="") as file:
            writer = csv.writer(file)
            writer.writerow(RAW_COLUMNS)
            writer.writerows(rows[part::2])


def test_csv_to_reports(spark, raw, stores, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    changes = [{"id": str(i), "product_name": f"P{i % 4}", "customer_email": f"c{i % 3}",
                "sale_date": "" if i % 5 == 0 else f"{i % 12 + 1}/1/2021"} for i in range(30)]
    rows = [tuple(r) for r in raw(*changes).collect()]
    write_csv(folder, rows)
    lake = FolderStore(spark, f"{tmp_path}/raw")
    for _ in range(2):
        ingest_raw(spark, str(folder), lake)
    assert lake.read(RAW_TABLE).count() == 30
    run_all(lake.read(RAW_TABLE), *stores)
    first = rows_of(stores[0], STAR_KEYS), rows_of(stores[1], MARTS)
    assert len(first[0]["fact_sales"]) == 30
    # A second run over the same sales in another order replaces everything.
    run_all(raw(*changes[::-1]).repartition(3), *stores, hold=True)
    assert (rows_of(stores[0], STAR_KEYS), rows_of(stores[1], MARTS)) == first


def test_reports_hold_no_nulls(raw, stores):
    run_all(raw({"customer_email": "", "product_rating": "", "sale_date": ""}), *stores)
    for table in MARTS:
        for row in stores[1].read(table).collect():
            assert None not in tuple(row)
    time = stores[1].read("report_sales_time").first()
    assert (time.year, time.month, time.month_name, time.year_month) == (0, 0, "", "null-null")
    quality = stores[1].read("report_product_quality").first()
    assert quality.avg_rating == 0 and quality.is_lowest_rated is True


def test_no_intermediate_table_is_left(spark, raw, stores):
    folder = run_folder(spark)
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    run_all(raw({}), *stores)
    assert set(os.listdir(folder)) == before


def test_an_error_in_the_star_stops_the_run(raw, stores):
    with pytest.raises(PySparkException):
        run_all(raw({}).drop("store_name"), *stores)
    with pytest.raises(PySparkException):
        stores[1].read("report_sales_products")


def test_catalog_tables(spark, raw):
    star, reports = CatalogStore(spark, "dwh"), CatalogStore(spark, "analytics")
    build_star(raw({}), star)
    build_marts(star_in(star), reports)
    assert {t.name for t in spark.catalog.listTables("dwh")} >= set(STAR_KEYS)
    assert {t.name for t in spark.catalog.listTables("analytics")} == set(MARTS)
    top = spark.sql("""SELECT product_name, product_brand, total_revenue, sales_rank
        FROM analytics.report_sales_products ORDER BY sales_rank LIMIT 10""")
    assert [tuple(r) for r in top.collect()] == [("Ball", "Acme", 10.0, 1)]


def test_reports_read_few_fact_columns(spark, raw, stores):
    build_star(raw({}), stores[0])
    plan = measures_by(star_in(stores[0]), "store")._jdf.queryExecution().executedPlan()
    scans = [line for line in plan.toString().splitlines() if "sale_total_price" in line
             and "FileScan" in line]
    assert len(scans) == 1
    read = scans[0].split("[")[1].split("]")[0]
    assert [name.split("#")[0] for name in read.split(",")] == [
        "store_key", "sale_quantity", "sale_total_price"]


def test_key_splits_cover_the_hashed_tables():
    assert set(key_splits(4)) == set(STAR_KEYS) - {"dim_date"}


def test_a_failed_run_changes_nothing_for_readers(spark, raw, tmp_path):
    store = PublishedStore(spark, f"{tmp_path}/lake")
    assert store.tables() == {}
    with store.draft() as draft:
        run_all(raw({}, {"id": "2"}), draft, draft)
    first = rows_of(store, (*STAR_KEYS, *MARTS))
    assert len(first) == 13 and len(first["fact_sales"]) == 2
    broken = raw({}, {"id": "3", "store_name": "Else"})
    with pytest.raises(RuntimeError, match="between tables"), store.draft() as draft:
        write, done = draft.write, []

        def fail_later(df, table, *more):
            if len(done) == 9:
                raise RuntimeError("between tables")
            done.append(table)
            write(df, table, *more)

        draft.write = fail_later
        run_all(broken, draft, draft)
    assert rows_of(store, (*STAR_KEYS, *MARTS)) == first
    reader = store.read("dim_store")
    with store.draft() as draft:
        run_all(broken, draft, draft)
    assert store.read("dim_store").count() == 2 and len(store.editions()) == 2
    assert reader.count() == 1  # a reader that began before goes on with what it saw
    store.forget(keep=1)
    assert len(store.editions()) == 1 and store.read("fact_sales").count() == 2
    assert len(os.listdir(tmp_path / "lake" / "dim_store")) == 2  # the failed run's is not listed


def test_two_runs_do_not_publish_over_each_other(spark, raw, tmp_path):
    store = PublishedStore(spark, f"{tmp_path}/lake")
    with store.draft() as draft:
        draft.write(spark.range(3), "three")
    with store.draft() as draft:
        draft.write(spark.range(4), "four")
    assert sorted(store.tables()) == ["four", "three"] and store.read("three").count() == 3
