"""Dimensions with few rows: copies go before rows are cleaned and keyed."""
from tallystar.plans.pipeline import build_star
from tallystar.plans.staging import stage, stage_copies_once
from tallystar.plans.star import BUILDERS, FEW_ROWS, star_of

CHANGES = (
    {}, {}, {"sale_customer_id": "0"}, {"sale_customer_id": " "}, {"customer_email": " ann@x "},
    {"customer_age": "41.9", "sale_seller_id": "x"}, {"customer_age": "41"},
    {"store_name": "a||b", "store_location": "c"}, {"store_name": "a", "store_location": "b||c"},
    {"supplier_name": None}, {"supplier_name": " "}, {"seller_email": "s@x", "sale_seller_id": "7.5"},
)


class Noted:
    """Takes the place of a store and keeps the frames."""

    def __init__(self):
        self.made = {}

    def write(self, df, table, order=(), mode="overwrite"):
        self.made[table] = df


def test_few_rows_are_keyed_after_copies_are_gone(raw, tmp_path):
    store = Noted()
    build_star(raw(*CHANGES), store, folder=str(tmp_path))
    for table in FEW_ROWS:
        plan = store.made[table]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("sha2(") < plan.rindex("Aggregate"), table


def test_few_rows_are_those_of_staging(raw):
    rows = raw(*CHANGES)
    star = star_of(stage(rows))
    for table in FEW_ROWS:
        found = BUILDERS[table](stage_copies_once(rows, table.removeprefix("dim_")))
        assert found.schema == star[table].schema
        assert sorted(map(str, found.collect())) == sorted(map(str, star[table].collect()))
