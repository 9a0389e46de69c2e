"""Every registered query against its SQL in DuckDB, over the smallest test tables."""
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tallystar.contract.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
              "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def in_order(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = [tuple(plain(row[c]) for c in columns) for row in df.collect()]
    answer = tables.execute(contract.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in answer.description}
    names = list(types)
    expected = [
        tuple(plain(row[names.index(c)]) for c in columns) for row in answer.fetchall()
    ]
    assert sorted(names) == columns
    for column in columns:
        spark_type = df.schema[column].dataType.simpleString()
        assert DUCK_TYPES.get(spark_type, spark_type.upper()) == types[column], column
    assert in_order(got) == in_order(expected)


def test_entry(spark):
    df = contract.entry(spark)
    assert "sales_rank" in df.columns and df.count() > 0
