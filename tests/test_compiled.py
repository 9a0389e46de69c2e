"""Generated methods that the JVM compiles, and numbers that copies of a sale differ in."""
import re

import pytest

from pyspark.sql import functions as F

from tallystar.contract import feed
from tallystar.functions import to_int
from tallystar.operators import Workspace, scratch_folder
from tallystar.plans.checks import dangling_keys, repeated_keys, row_counts
from tallystar.plans.staging import stage
from tallystar.plans.star import BUILDERS, Star, combined, fact_sales

# A longer method is never compiled.
MOST = 8000


def longest_method(df):
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "codegen")
    return max(int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text))


@pytest.mark.parametrize("made", [
    stage, lambda rows: fact_sales(stage(rows)), lambda rows: combined(stage(rows))])
def test_staging_is_compiled(raw, settings, made):
    settings("spark.sql.adaptive.enabled", "false")
    rows = raw({}, {"id": "2"}).repartition(2)
    assert longest_method(made(rows)) < MOST


@pytest.mark.parametrize("text, number", [
    ("7.9", 7), ("-7.9", -7), (" +7. ", 7), (".5", 0), ("-.5", 0), (".", 0), ("+.", 0),
    ("\t8.5\n", 8), ("007.1", 7), ("99999999999.5", None), ("1.2.3", None), ("1e3.0", None),
    ("$1.5", None), ("- 7.5", None), ("", None), (None, None)])
def test_fractions_are_cut_off(spark, text, number):
    row, = spark.createDataFrame([(text,)], "t string").select(to_int("t").alias("n")).collect()
    assert row.n == number


def test_least_numbers_of_copies_stay_together(raw):
    rows = raw(
        {"sale_customer_id": "1", "sale_seller_id": "9"},
        {"sale_customer_id": "2", "sale_seller_id": "3"},
        {"sale_customer_id": "2", "sale_seller_id": "3", "id": "2"},
        {"sale_customer_id": "", "sale_seller_id": "7", "id": "2"},
        {"sale_customer_id": "4", "sale_seller_id": "5", "id": "3"},
        {"sale_customer_id": "6", "sale_seller_id": "5", "id": "3"})
    found = fact_sales(stage(rows)).orderBy(F.col("source_row_id")).collect()
    assert [(r.source_customer_id, r.source_seller_id) for r in found] == [
        (1, 9), (None, 7), (4, 5)]


def test_checks_move_only_keys(spark, raw):
    asked = []

    def open_table(table, columns):
        asked.append(columns)
        return BUILDERS[table](stage(raw({}, {"id": "2"}, {"id": "2"})), columns)

    counts = {r.table_name: r.row_count for r in row_counts(Star(open_table)).collect()}
    assert counts["fact_sales"] == 2 and counts["dim_product"] == 1
    assert not repeated_keys(Star(open_table)).collect()
    assert not dangling_keys(Star(open_table)).collect()
    assert None not in asked
    plan = open_table("dim_product", ())._jdf.queryExecution().optimizedPlan().toString()
    assert "product_name" not in plan[:plan.index("Project")]


def test_reports_hold_half_of_each_key(spark, raw, monkeypatch):
    rows = stage(raw({}, {"id": "2"}, {"id": "2"}))
    monkeypatch.setattr(feed, "staged_sales", lambda *_: rows)
    with Workspace(spark, scratch_folder(spark, "held")) as work:
        star = feed.held_star(spark, "", work, ("fact_sales", "dim_store"), ("store_key",))
        found = star.columns("fact_sales", "store_key").collect()
    whole = {bytes.fromhex(r.sale_key) for r in rows.collect()}
    assert {bytes(r.sale_key) for r in found} == {key[:16] for key in whole}
    assert len(found) == 2
