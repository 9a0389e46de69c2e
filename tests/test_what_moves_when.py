"""What large joins move, and when exchanges of finished tables go."""
from tallystar.plans import pipeline
from tallystar.plans.dataset import sales_dataset
from tallystar.plans.staging import stage
from tallystar.plans.star import BUILDERS, star_of


def test_product_columns_are_not_moved_for_customers(raw):
    sales = sales_dataset(star_of(stage(raw({}, {"id": "2", "product_name": "Bat"}))))
    plan = sales._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter, (product_key") < plan.index("Join LeftOuter, (customer_key")
    assert {(r.product_name, r.customer_email) for r in sales.collect()} == {
        ("Ball", "ann@x"), ("Bat", "ann@x")}


class Noted:
    def __init__(self, seen):
        self.seen = seen

    def write(self, df, table, order=(), mode="overwrite"):
        self.seen.append(table)


def test_the_fact_is_made_when_the_dimensions_exchanges_are_gone(raw, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(pipeline, "release_exchanges", lambda spark: seen.append("released"))
    pipeline.build_star(raw({}), Noted(seen), folder=str(tmp_path))
    assert set(seen[:6]) == {*BUILDERS} - {"fact_sales"}
    assert seen[6:] == ["released", "fact_sales", "released"]
