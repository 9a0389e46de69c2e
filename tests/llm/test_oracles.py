"""Text queries against their SQL in DuckDB, over the smallest test tables."""
import glob
import os

import duckdb
import pytest

from tallystar.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN"}


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {table} as select * from '{path}'")
    answer = connection.execute(ORACLES[name])
    types = {c[0]: str(c[1]) for c in answer.description}
    df = QUERIES[name](spark, FOLDER)
    assert sorted(types) == sorted(df.columns)
    assert {n: TYPES[t] for n, t in df.dtypes} == types
    got = sorted(str([plain(r[c]) for c in types]) for r in df.collect())
    assert got == sorted(str([plain(v) for v in r]) for r in answer.fetchall())
