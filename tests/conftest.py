import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallystar.operators import remove_run_folder  # noqa: E402
from tallystar.plans.columns import RAW_COLUMNS  # noqa: E402
from tallystar.sources.csv_folder import RAW_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tallystar-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_run_folder(session)
    assert not [name for name in os.listdir(shared) if name.startswith("tallystar-")]
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


SALE = {
    "id": "1", "customer_first_name": "Ann", "customer_last_name": "Lee",
    "customer_email": "ann@x", "customer_country": "Peru", "seller_first_name": "Bo",
    "product_name": "Ball", "product_category": "Toy", "product_price": "5.00",
    "product_brand": "Acme", "product_rating": "4.5", "product_reviews": "10",
    "sale_date": "3/5/2021", "sale_customer_id": "1", "sale_seller_id": "1",
    "sale_product_id": "1", "sale_quantity": "2", "sale_total_price": "10.00",
    "store_name": "North", "store_city": "Lima", "store_country": "Peru",
    "supplier_name": "Sup", "supplier_country": "Peru",
}


@pytest.fixture
def raw(spark):
    """Raw rows from what differs from one ordinary sale."""

    def make(*changes):
        rows = [
            tuple({**SALE, **change}.get(name, "") for name in RAW_COLUMNS) for change in changes
        ]
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return make
