"""What is moved and held: keys as bytes, few columns, narrow rows."""
import glob

import pytest

from pyspark.sql import functions as F

from tallystar.contract import feed
from tallystar.plans.staging import stage
from tallystar.plans.star import fact_sales
from tallystar.sources import FolderStore


class Kept:
    """Takes the place of a workspace and keeps the frames."""

    def hold(self, df, label, by=None):
        self.df = df
        return df


def test_sales_are_grouped_by_bytes(raw):
    sales = fact_sales(stage(raw({}, {})))
    plan = sales._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex(" in plan
    row, = sales.collect()
    assert len(row.sale_key) == 64 and row.sale_key == row.sale_key.lower()


def test_reports_hold_only_what_they_read(spark, raw, monkeypatch):
    monkeypatch.setattr(feed, "staged_sales", lambda *_: stage(raw({}, {"id": "2"})))
    kept = Kept()
    wanted = ("store_key", "sale_total_price", "sale_quantity")
    star = feed.held_star(spark, "", kept, ("fact_sales", "dim_store"), wanted)
    types = dict(kept.df.dtypes)
    assert types["sale_key"] == types["store_key"] == "binary"
    assert not {"customer_key", "product_key", "source_row_id"} & {*types}
    assert star.columns("fact_sales", *wanted).count() == 2
    assert star["dim_store"].count() == 1


@pytest.fixture
def folder(spark, tmp_path):
    tables = {
        "region": "0 as r_regionkey, 'ASIA' as r_name",
        "nation": "0 as n_nationkey, 'JAPAN' as n_name, 0 as n_regionkey",
        "supplier": "cast(1 as bigint) as s_suppkey, 'S' as s_name, 0 as s_nationkey",
        "customer": "cast(1 as bigint) as c_custkey, 'C#1' as c_name, 0 as c_nationkey,"
                    " 'PETS' as c_mktsegment",
        "orders": "cast(id as bigint) as o_orderkey, cast(id as bigint) as o_custkey,"
                  " timestamp'2021-03-05' as o_orderdate",
        "part": "cast(1 as bigint) as p_partkey, 'P' as p_name, 'B' as p_brand, 'T' as p_type,"
                " 3 as p_size, 9.5D as p_retailprice",
        "lineitem": "cast(id as bigint) as l_orderkey, 1 as l_linenumber,"
                    " cast(1 as bigint) as l_partkey, 12 * id + 1 - 12 as l_suppkey,"
                    " 2.0D as l_quantity, 10.005D as l_extendedprice",
    }
    for name, columns in tables.items():
        rows = spark.range(1, 3 if name in ("orders", "lineitem") else 2)
        rows.selectExpr(*columns.split(", ")
                        ).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_feed_moves_no_lines_for_suppliers(spark, folder):
    rows = feed.raw_sales(spark, folder)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_suppkey" not in plan
    found, missing = rows.orderBy(F.col("id").cast("int")).collect()
    assert (found.supplier_name, found.supplier_city, found.supplier_country) == (
        "S", "JAPAN", "ASIA")
    assert (found.customer_last_name, found.customer_country, found.customer_age) == (
        "1", "JAPAN", "19")
    # The second line's supplier, 13, and customer are in no table.
    assert missing.supplier_name is None and missing.supplier_city is None
    assert missing.customer_age is None and missing.customer_postal_code is None
    assert found.sale_quantity == "2" and found.sale_date == "3/5/2021"


def test_stored_tables_are_packed_well(spark, tmp_path):
    FolderStore(spark, str(tmp_path)).write(spark.range(3), "t")
    assert glob.glob(f"{tmp_path}/t/*.zstd.parquet")
