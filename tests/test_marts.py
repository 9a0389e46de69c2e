"""Reports against a plain Python reading of their rules."""
import math
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallystar.functions import hash_key
from tallystar.operators import Workspace, run_folder
from tallystar.plans import checks, marts
from tallystar.plans.dataset import measures_by, measures_of, sales_dataset
from tallystar.plans.marts import MARTS, mart
from tallystar.plans.staging import stage
from tallystar.plans.star import star_of

CENT = Decimal("0.01")


@pytest.fixture
def work(spark):
    with Workspace(spark, run_folder(spark)) as work:
        yield work


def varied():
    """Sales with missing emails, ratings and dates, gaps, ties and zero revenue."""
    rows = []
    for i in range(240):
        rows.append({
            "id": str(i),
            "customer_email": "" if i % 7 == 0 else f"c{i % 13}@x",
            "customer_last_name": f"L{i % 3}",
            "customer_country": ["Peru", "Chad", ""][i % 3],
            "product_name": f"P{i % 17}", "product_brand": f"B{i % 2}",
            "product_category": ["Toy", "Food", ""][i % 3],
            "product_rating": "" if i % 17 == 5 else f"{(i % 17) % 4}.5",
            "product_reviews": str((i % 17) * 3 % 10), "product_price": f"{i % 17}.25",
            "sale_date": ["", "1/5/2020", "3/9/2020", "12/1/2021", "2/2/2022"][i % 5],
            "sale_quantity": str(i % 4), "sale_total_price": "x" if i % 19 == 0 else
            ("0" if i % 5 == 1 else f"{i % 11}.{i % 100:02d}"),
            "store_name": f"S{i % 9}", "store_city": f"C{i % 4}",
            "store_country": ["Peru", "Chad"][i % 2],
            "supplier_name": "" if i % 6 == 0 else f"Sup{i % 6}",
            "supplier_country": ["Peru", "Chad", ""][i % 3],
        })
    return rows


def mean(values):
    values = [v for v in values if v is not None]
    if not values:
        return None
    return float((sum(map(Decimal, map(str, values))) / len(values)).quantize(
        CENT, ROUND_HALF_UP))


def total(values):
    values = [v for v in values if v is not None]
    return sum(values) if values else None


def dense(rows, *order):
    """Ranks by (value, descending); missing values last down and first up."""
    def place(row):
        return tuple(
            (row[n] is None, -(row[n] or 0)) if down else (row[n] is not None, row[n] or 0)
            for n, down in order)
    places = sorted({place(row) for row in rows})
    return [places.index(place(row)) + 1 for row in rows]


def groups_of(sales, grain):
    found = defaultdict(list)
    for sale in sales:
        found[tuple(sale[name] for name in grain)].append(sale)
    return found


def money(values):
    found = total([None if v is None else Decimal(str(v)) for v in values])
    return None if found is None else float(found)


def collect(df):
    return [row.asDict() for row in df.collect()]


@pytest.fixture
def star(raw):
    return star_of(stage(raw(*varied())))


@pytest.fixture
def sales(star):
    return collect(sales_dataset(star))


@pytest.mark.parametrize("name", MARTS)
def test_added_up_equals_row_by_row(star, work, name):
    chosen = MARTS[name]
    quick = chosen.report(work.hold(chosen.groups(measures_by(star, chosen.entity)), "a"), work)
    dataset = measures_of(sales_dataset(star))
    slow = chosen.report(work.hold(chosen.groups(dataset), "b"), work)
    assert quick.schema.simpleString() == slow.schema.simpleString()
    assert sorted(map(str, quick.collect())) == sorted(map(str, slow.collect()))


def test_product_sales(star, sales, work):
    rows = collect(mart("report_sales_products", star, work))
    groups = groups_of(sales, marts.PRODUCT_GRAIN)
    assert len(rows) == len(groups)
    for row in rows:
        members = groups[tuple(row[name] for name in marts.PRODUCT_GRAIN)]
        assert row["total_revenue"] == money(s["sale_total_price"] for s in members)
        assert row["total_sales_quantity"] == total([s["sale_quantity"] for s in members])
        assert row["order_count"] == len({s["sale_key"] for s in members})
        assert row["avg_rating"] == mean([s["product_rating"] for s in members])
        assert row["total_reviews"] == total([s["product_reviews"] for s in members])
        assert row["category_revenue"] == money(
            s["sale_total_price"] for s in sales
            if s["product_category"] == row["product_category"])
        assert row["is_top_10_product"] == (row["sales_rank"] <= 10)
    assert [r["sales_rank"] for r in rows] == dense(
        rows, ("total_sales_quantity", True), ("total_revenue", True))


def test_customer_sales(star, sales, work):
    rows = collect(mart("report_sales_customers", star, work))
    groups = groups_of(sales, marts.CUSTOMER_GRAIN)
    assert len(rows) == len(groups)
    for row in rows:
        members = groups[tuple(row[name] for name in marts.CUSTOMER_GRAIN)]
        assert row["total_spent"] == money(s["sale_total_price"] for s in members)
        assert row["order_count"] == len(members)
        assert row["avg_check"] == mean([s["sale_total_price"] for s in members])
        assert row["total_items"] == total([s["sale_quantity"] for s in members])
        assert row["country_customer_count"] == sum(
            key[0] is not None and key[2] == row["customer_country"] for key in groups)
    assert [r["customer_rank"] for r in rows] == dense(
        rows, ("total_spent", True), ("order_count", True))
    # The key is the email's alone, so groups without one share it.
    without = [r["customer_key"] for r in rows if r["customer_email"] is None]
    assert len(without) > 1 and len(set(without)) == 1


def test_time_sales(star, sales, work):
    rows = collect(checks.time_trend(mart("report_sales_time", star, work)))
    assert [(r["year"], r["month"], r["year_month"]) for r in rows] == [
        (None, None, "null-null"), (2020, 1, "2020-01"), (2020, 3, "2020-03"),
        (2021, 12, "2021-12"), (2022, 2, "2022-02")]
    groups = groups_of(sales, ("year", "month"))
    before = 0.0
    for row in rows:
        members = groups[row["year"], row["month"]]
        now = money(s["sale_total_price"] for s in members)
        assert row["total_revenue"] == now
        assert row["year_total_revenue"] == money(
            s["sale_total_price"] for s in sales if s["year"] == row["year"])
        assert row["avg_order_size"] == mean([s["sale_total_price"] for s in members])
        assert row["previous_period_revenue"] == before
        assert row["revenue_diff_prev_period"] == round(now - before, 2)
        growth = 0.0 if before == 0 else round((now - before) / before * 100, 2)
        assert row["revenue_growth_pct"] == growth
        before = now
    # January has no revenue, so March grows by 0 from a previous 0.
    assert rows[1]["total_revenue"] == 0.0 and rows[2]["revenue_growth_pct"] == 0.0


def test_store_sales(star, sales, work):
    rows = collect(mart("report_sales_stores", star, work))
    groups = groups_of(sales, marts.STORE_GRAIN)
    assert len(rows) == len(groups)
    for row in rows:
        members = groups[tuple(row[name] for name in marts.STORE_GRAIN)]
        assert row["total_revenue"] == money(s["sale_total_price"] for s in members)
        assert row["avg_check"] == mean([s["sale_total_price"] for s in members])
        assert row["country_revenue"] == money(
            s["sale_total_price"] for s in sales if s["store_country"] == row["store_country"])
        assert row["city_revenue"] == money(
            s["sale_total_price"] for s in sales
            if (s["store_city"], s["store_country"]) == (row["store_city"], row["store_country"]))
        assert row["is_top_5_store"] == (row["store_rank"] <= 5)
    assert [r["store_rank"] for r in rows] == dense(
        rows, ("total_revenue", True), ("order_count", True))


def test_supplier_sales(star, sales, work):
    rows = collect(mart("report_sales_suppliers", star, work))
    groups = groups_of(sales, marts.SUPPLIER_GRAIN)
    assert len(rows) == len(groups)
    for row in rows:
        members = groups[tuple(row[name] for name in marts.SUPPLIER_GRAIN)]
        assert row["total_revenue"] == money(s["sale_total_price"] for s in members)
        assert row["avg_product_price"] == mean([s["product_price"] for s in members])
        assert row["order_count"] == len(members)
        assert row["country_supplier_count"] == sum(
            key[0] is not None and key[1] == row["supplier_country"] for key in groups)
        assert row["is_top_5_supplier"] == (row["supplier_rank"] <= 5)


def test_product_quality(star, sales, work):
    rows = collect(mart("report_product_quality", star, work))
    assert len(rows) == len(groups_of(sales, marts.PRODUCT_GRAIN))
    assert [r["highest_rating_rank"] for r in rows] == dense(
        rows, ("avg_rating", True), ("total_reviews", True))
    assert [r["lowest_rating_rank"] for r in rows] == dense(
        rows, ("avg_rating", False), ("total_reviews", True))
    assert [r["reviews_rank"] for r in rows] == dense(rows, ("total_reviews", True))
    unrated = [r for r in rows if r["avg_rating"] is None]
    assert unrated and any(r["is_lowest_rated"] for r in unrated)
    pairs = [(r["avg_rating"], r["total_sales_quantity"]) for r in rows
             if r["avg_rating"] is not None]
    n = len(pairs)
    mx, my = sum(x for x, _ in pairs) / n, sum(y for _, y in pairs) / n
    cov = sum((x - mx) * (y - my) for x, y in pairs)
    spread = (sum((x - mx) ** 2 for x, _ in pairs) * sum((y - my) ** 2 for _, y in pairs)) ** 0.5
    assert {r["sales_rating_correlation"] for r in rows} == {round(cov / spread, 4)}
    extremes = collect(checks.rating_extremes(mart("report_product_quality", star, work)))
    assert len(extremes) == sum(r["is_highest_rated"] or r["is_lowest_rated"] for r in rows)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("changes", [
    [{}],
    [{"product_name": "A"}, {"product_name": "B", "id": "2", "sale_quantity": "9"}],
    [{"product_rating": ""}],
])
def test_correlation_of_constant_input_is_null(raw, work, settings, ansi, changes):
    settings("spark.sql.ansi.enabled", ansi)
    rows = collect(mart("report_product_quality", star_of(stage(raw(*changes))), work))
    assert {r["sales_rating_correlation"] for r in rows} == {None}
    assert all(r["has_most_reviews"] for r in rows)


def test_top_products_settles_ties(raw, work):
    changes = [{"id": str(i), "product_name": f"P{i:02d}"} for i in range(15)]
    report = mart("report_sales_products", star_of(stage(raw(*changes))), work)
    assert report.where("is_top_10_product").count() == 15
    top = checks.top_products(report)
    assert [r.product_name for r in top.collect()] == [f"P{i:02d}" for i in range(10)]
    assert top.columns == ["product_name", "product_brand", "total_revenue", "sales_rank"]


def test_no_sales(raw, work):
    star = star_of(stage(raw({}).limit(0)))
    for name in MARTS:
        assert mart(name, star, work).collect() == []


def test_mart_keys(star, work, spark):
    for name, columns in (("report_sales_stores", marts.STORE_GRAIN),
                          ("report_sales_suppliers", marts.SUPPLIER_GRAIN)):
        report = mart(name, star, work)
        key = report.columns[0]
        assert report.where(report[key] != hash_key(*columns)).count() == 0


def test_every_rating_and_total_counts(raw, work, settings):
    """Ratings too large for exact sums, NaN, and long ones: under either ANSI setting."""
    rows = [("Huge", "1"), ("Huge", "10000000000000"), ("Odd", "3"), ("Odd", "NaN"),
            ("Long", "4.1234567"), ("Long", "4.1234567"), ("Plain", "4.5"), ("Plain", "")]
    sales = raw(*({"id": str(i), "product_name": name, "product_rating": rating}
                  for i, (name, rating) in enumerate(rows)))
    for ansi in ("true", "false"):
        settings("spark.sql.ansi.enabled", ansi)
        star = star_of(stage(sales))
        for measures in (measures_by(star, "product"), measures_of(sales_dataset(star))):
            got = {r.product_name: r.avg_rating for r in marts.product_groups(measures).collect()}
            assert got.pop("Odd") != got.get("Odd")  # NaN
            assert got == {"Huge": 5000000000000.5, "Long": 4.12, "Plain": 4.5}


def test_large_totals_count_and_impossible_ones_stop(spark, raw, settings):
    dataset = sales_dataset(star_of(stage(raw({}, {"id": "2"}))))
    large = dataset.withColumn("sale_total_price", F.lit(1e17))
    impossible = dataset.withColumn("sale_total_price", F.lit(float("nan")))
    for ansi in ("true", "false"):
        settings("spark.sql.ansi.enabled", ansi)
        assert float(marts.store_groups(measures_of(large)).first().total_revenue) == 2e17
        with pytest.raises(PySparkException, match="does not fit"):
            marts.store_groups(measures_of(impossible)).collect()


def test_repeated_sales_are_one_order(raw):
    dataset = sales_dataset(star_of(stage(raw({}, {"id": "2"}))))
    row = marts.store_groups(measures_of(dataset.unionByName(dataset))).first()
    assert (row.order_count, row.total_items, float(row.total_revenue)) == (2, 8, 40.0)


def test_means_of_odd_ratings_do_not_hang_on_the_order(raw):
    """Doubles of all sizes: the same bits however the sales are dealt, and the right ones."""
    rng = random.Random(3)
    ratings = [repr(rng.uniform(-1, 1) * 10.0 ** rng.randint(-9, 18)) for _ in range(120)]
    changes = [{"id": str(i), "product_rating": r, "product_description": str(i),
                "product_name": f"P{i % 2}"} for i, r in enumerate(ratings)]
    expected = {}
    for name in ("P0", "P1"):
        own = [Fraction(c["product_rating"]) for c in changes if c["product_name"] == name]
        expected[name] = float(sum(own) / len(own))
    seen = set()
    for seed, parts in ((0, 1), (1, 3), (2, 7)):
        random.Random(seed).shuffle(changes)
        star = star_of(stage(raw(*changes).repartition(parts)))
        groups = marts.product_groups(measures_by(star, "product")).collect()
        got = {r.product_name: r.avg_rating for r in groups}
        assert got == pytest.approx(expected, rel=1e-12)
        seen.add(tuple(sorted(got.items())))
    assert len(seen) == 1


@pytest.mark.parametrize("ratings, expected", [
    (["1e400", "2"], math.inf), (["1e400", "-1e400"], math.nan), (["NaN", "1e400"], math.nan),
    (["-1e400", "5"], -math.inf), (["NaN"], math.nan), (["", "4.1234567"], 4.12)])
def test_endless_ratings(raw, ratings, expected):
    changes = [{"id": str(i), "product_rating": r, "product_description": str(i)}
               for i, r in enumerate(ratings)]
    star = star_of(stage(raw(*changes)))
    (row,) = marts.product_groups(measures_by(star, "product")).collect()
    assert row.avg_rating == pytest.approx(expected, nan_ok=True)
