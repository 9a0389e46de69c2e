"""The checks of keys: tables are read once, keys move as they are."""
import pytest

from tallystar.operators import Workspace
from tallystar.plans.checks import REFERENCES, dangling_keys, repeated_keys
from tallystar.plans.staging import stage
from tallystar.plans.star import BUILDERS, STAR_KEYS, Star, packed_keys, star_of

ROWS = (
    {}, {}, {"id": "2", "customer_email": "bo@x", "sale_date": "x"},
    {"id": "3", "store_name": "South", "supplier_name": "Other", "sale_date": "4/5/2021"},
    {"id": "4", "product_name": "Bat", "seller_first_name": "Cy", "store_name": "South"},
)
# Rows that are left of tables with gaps.
GAPS = {"dim_customer": "customer_email = 'bo@x'", "dim_store": "store_name = 'North'",
        "dim_supplier": "false", "dim_date": "month = 3 and day_of_month = 5"}


def with_gaps(star):
    return {table: star[table].where(GAPS.get(table, "true")) for table in STAR_KEYS}


def expected(tables):
    found = set()
    for table, key, target in REFERENCES:
        there = {row[key] for row in tables[target].collect()}
        found |= {(table, target, str(row[key])) for row in tables[table].collect()
                  if row[key] is not None and row[key] not in there}
    return found


@pytest.mark.parametrize("packed", [False, True])
def test_missing_rows_are_found(spark, raw, tmp_path, packed):
    staged = stage(raw(*ROWS))
    tables = with_gaps(star_of(packed_keys(staged) if packed else staged))
    wanted = expected(with_gaps(star_of(staged)))
    assert len({target for _, target, _ in wanted}) == len(GAPS)
    with Workspace(spark, str(tmp_path / "held")) as work:
        for held in (None, work):
            found = [tuple(r) for r in dangling_keys(tables, held).collect()]
            assert len(found) == len(set(found)) and set(found) == wanted


def test_a_table_is_read_once_for_all_its_references(raw):
    asked = []

    def open_table(table, columns):
        asked.append((table, tuple(columns)))
        return BUILDERS[table](stage(raw({}, {"id": "2"})), columns)

    dangling_keys(Star(open_table))
    assert [len(columns) for table, columns in asked if table == "fact_sales"] == [5]


def test_repeated_bytes_are_grouped_without_another_exchange(raw):
    star = star_of(packed_keys(stage(raw(*ROWS))))
    plan = repeated_keys(star)._jdf.queryExecution().executedPlan().toString()
    assert "cast(sale_key" not in plan and plan.count("hashpartitioning(sale_key") == 1


@pytest.mark.parametrize("packed", [False, True])
def test_repeated_keys_are_shown_as_text(raw, packed):
    staged = stage(raw(*ROWS))
    star = dict(star_of(packed_keys(staged) if packed else staged))
    for table in ("dim_store", "dim_date"):
        star[table] = star[table].union(star[table])
    found = {(r.table_name, r.key, r.row_count) for r in repeated_keys(star).collect()}
    plain = star_of(staged)
    assert found == {(table, str(row[STAR_KEYS[table]]), 2) for table in ("dim_store", "dim_date")
                     for row in plain[table].collect()}
