"""Joined keys as bytes, whole datasets staged once, packed files."""
import glob
import gzip

import pytest

from pyspark.sql import functions as F

from tallystar.contract import feed, queries
from tallystar.functions.keys import key_bytes
from tallystar.operators import Workspace
from tallystar.plans.dataset import in_bytes
from tallystar.plans.pipeline import build_star
from tallystar.plans.staging import stage
from tallystar.plans.star import star_of
from tallystar.sources import FolderStore, PublishedStore
from tallystar.sources.csv_folder import RAW_SCHEMA, read_raw_csv


@pytest.fixture
def folder(spark, tmp_path):
    tables = {
        "region": "0 as r_regionkey, 'ASIA' as r_name",
        "nation": "0 as n_nationkey, 'JAPAN' as n_name, 0 as n_regionkey",
        "supplier": "cast(1 as bigint) as s_suppkey, 'S' as s_name, 0 as s_nationkey",
        "customer": "id as c_custkey, 'C#1' as c_name, 0 as c_nationkey, 'PETS' as c_mktsegment",
        "orders": "id as o_orderkey, id as o_custkey, timestamp'2021-03-05 23:59:59' as o_orderdate",
        "part": "cast(1 as bigint) as p_partkey, 'P' as p_name, 'B' as p_brand, 'T' as p_type,"
                " 3 as p_size, 9.5D as p_retailprice",
        "lineitem": "id as l_orderkey, 1 as l_linenumber, cast(1 as bigint) as l_partkey,"
                    " cast(1 as bigint) as l_suppkey, 2.0D as l_quantity,"
                    " 10.005D as l_extendedprice",
    }
    for name, columns in tables.items():
        # Line 166 has no order; orders 79 and 83 have dates that no one can read.
        rows = spark.createDataFrame(
            [(i,) for i in {"lineitem": (1, 79, 83, 166), "orders": (1, 79, 83),
                            "customer": (1,)}.get(name, (1,))], "id bigint")
        rows.selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def plan_of(df, which="executedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def test_orders_are_moved_as_days(spark, folder):
    rows = feed.raw_sales(spark, folder, ["sale"])
    assert {r.id: r.sale_date for r in rows.select("id", "sale_date").collect()} == {
        "9": "3/5/2021", "633": "", "665": "13/45/2021", "1329": None}
    plan = plan_of(rows)
    assert plan.index("date_format(") < plan.index("Join")


def test_lines_without_orders_are_not_dealt(spark, folder):
    rows = feed.raw_sales(spark, folder, ["product"])
    assert "hashpartitioning(l_orderkey" not in plan_of(rows)
    assert rows.count() == 4


def test_facts_are_joined_by_bytes(spark, folder):
    joined = queries.QUERIES["join_fact_product"](spark, folder)
    plan = plan_of(joined, "optimizedPlan")
    assert plan.index("lower(hex(product_key") < plan.index("Join")
    plain = feed.feed_star(spark, folder).columns("fact_sales", "product_key")
    assert joined.select("sale_key", "product_key").exceptAll(plain).isEmpty()
    assert joined.where("product_name = 'P'").count() == 4


def test_the_dataset_is_staged_once(spark, folder):
    sales = queries.QUERIES["sales_dataset"](spark, folder)
    assert not [name for name in sales.inputFiles() if "lineitem" in name]
    keys = feed.feed_star(spark, folder).columns("fact_sales")
    assert sales.select("sale_key").exceptAll(keys).isEmpty() and sales.count() == 4


def test_no_two_keys_are_the_same_bytes(spark):
    keys = ["ab" * 32, "AB" * 32, "«" * 16, "00" * 32, "p1", "", "x" * 64, None]
    rows = spark.createDataFrame([(key,) for key in keys], "k string")
    found = [r.k and bytes(r.k) for r in rows.select(key_bytes("k")).collect()]
    assert found[0] == b"\xab" * 32 and found[-1] is None
    assert len({*found}) == len(keys)


def test_measures_move_keys_as_bytes(raw):
    star = in_bytes(star_of(stage(raw({}, {"id": "2"}))))
    assert dict(star.columns("fact_sales", "store_key").dtypes) == {
        "sale_key": "binary", "store_key": "binary"}
    joined = star["fact_sales"].join(star["dim_store"], "store_key")
    assert joined.count() == 2


def test_one_pass_holds_keys_as_bytes(spark, raw, tmp_path, monkeypatch):
    held, hold = {}, Workspace.hold

    def noted(self, df, label, by=None):
        held[label] = dict(df.dtypes)
        return hold(self, df, label, by)

    monkeypatch.setattr(Workspace, "hold", noted)
    rows = raw({}, {"id": "2"}, {"id": "2"})
    store = FolderStore(spark, str(tmp_path))
    build_star(rows, store, hold=True)
    assert held["combined"]["sale_key"] == held["combined"]["product_key"] == "binary"
    plain = star_of(stage(rows))
    for table in ("fact_sales", "dim_product", "dim_customer", "dim_supplier"):
        shown = [c for c in plain[table].columns if c != "loaded_at"]
        assert store.read(table).select(shown).exceptAll(plain[table].select(shown)).isEmpty()
        assert store.read(table).count() == plain[table].count()


def test_drafts_are_packed_well(spark, tmp_path):
    with PublishedStore(spark, str(tmp_path)).draft() as draft:
        draft.write(spark.range(3), "t")
    assert glob.glob(f"{tmp_path}/t/*/*.zstd.parquet")


def test_a_failing_run_reads_the_stored_feed(spark, monkeypatch):
    made, read = [], []
    monkeypatch.setattr(queries, "raw_sales", lambda *_: made.append(1) or spark.range(20))
    monkeypatch.setattr(queries, "run_all", lambda *_: None)
    monkeypatch.setattr(queries, "build_star", lambda raw, store: read.append(raw.count()))
    with pytest.raises(KeyError):
        queries.publish_everything(spark, "")
    assert made == [1] and read == [9]


@pytest.mark.parametrize("multi_line", [True, False])
def test_packed_csv_is_read(spark, tmp_path, multi_line):
    names = ",".join(RAW_SCHEMA.names)
    for name, begin in (("a.csv.gz", gzip.open), ("b.csv", open)):
        with begin(tmp_path / name, "wt") as file:
            file.write(f"{names}\n{name}{',' * (len(RAW_SCHEMA) - 1)}\n")
    rows = read_raw_csv(spark, str(tmp_path), multi_line).select(F.col("id")).collect()
    assert sorted(r.id for r in rows) == ["a.csv.gz", "b.csv"]
