import hashlib
import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.functions import (
    blank_to_null,
    date_key,
    hash_cleaned,
    hash_key,
    mean_in_cents,
    null_fill,
    to_date,
    to_decimal,
    to_double,
    to_int,
)

ANSI = "spark.sql.ansi.enabled"


def run(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
class TestCleaning:
    def test_text(self, spark, settings, ansi):
        settings(ANSI, ansi)
        got = run(spark, [" a ", "", "  ", None, "\ta", "b\n"], blank_to_null("v"))
        assert got == ["a", None, None, None, "\ta", "b\n"]

    def test_int(self, spark, settings, ansi):
        settings(ANSI, ansi)
        values = ["7", " 7 ", "12.9", "-12.9", "abc", "99999999999", "1e3", "", None, ".5",
                  "5.", "+3", "2147483648", "12.9999999999999999999999", "1.2.3", "-", "7 8"]
        assert run(spark, values, to_int("v")) == [
            7, 7, 12, -12, None, None, None, None, None, 0, 5, 3, None, 12, None, None, None]
        assert run(spark, ["99999999999", "99999999999.5"], to_int("v", "bigint")) == [
            99999999999, 99999999999]

    def test_decimal(self, spark, settings, ansi):
        settings(ANSI, ansi)
        got = run(spark, ["1.005", "-1.005", "x", "123456789012345678901", "1e3", " 2 ", ""],
                  to_decimal("v"))
        assert got == [Decimal("1.01"), Decimal("-1.01"), None, None, Decimal("1000.00"),
                       Decimal("2.00"), None]

    def test_double(self, spark, settings, ansi):
        settings(ANSI, ansi)
        assert run(spark, ["4.5", "x", " ", "1e3"], to_double("v")) == [4.5, None, None, 1000.0]

    def test_date(self, spark, settings, ansi):
        settings(ANSI, ansi)
        got = run(spark, ["3/5/2021", "03/05/2021", "13/45/2021", "3/5/21", "", "2/29/2021",
                          "2021-03-05"], to_date("v"))
        assert got == [date(2021, 3, 5), date(2021, 3, 5), None, None, None, None, None]
        assert run(spark, ["2021-03-05"], to_date("v", "yyyy-MM-dd")) == [date(2021, 3, 5)]


def test_cleaning_equals_lenient_casts(spark, settings):
    """Without ANSI rules a plain cast never raises; cleaning must agree with it."""
    settings(ANSI, "false")
    rng = random.Random(7)
    values = ["".join(rng.choices("0129+-. \t\ne", k=rng.randint(1, 7))) for _ in range(4000)]
    values += ["2147483647", "-2147483648", "2147483648.1", "\t7\n", "\x007"]
    text = F.when(F.trim("v") != "", F.trim("v"))
    df = spark.createDataFrame([(v,) for v in values], "v string").select(
        "v", to_int("v").alias("i"), text.cast("int").alias("ci"),
        to_decimal("v").alias("d"), text.cast("decimal(18,2)").alias("cd"),
        to_double("v").alias("f"), text.cast("double").alias("cf"),
    )
    wrong = df.where("not (i <=> ci) or not (d <=> cd) or not (f <=> cf)").collect()
    assert wrong == []


class TestKeys:
    def test_hash(self, spark):
        df = spark.createDataFrame([("a", None), ("a", ""), (" a ", "  ")], "x string, y string")
        keys = {r[0] for r in df.select(hash_key("x", "y")).collect()}
        assert keys == {hashlib.sha256(b"a||").hexdigest()}

    def test_order_and_empty(self, spark):
        row = spark.createDataFrame([("a", "b", None)], "x string, y string, z string").select(
            hash_key("x", "y"), hash_key("y", "x"), hash_key("z"),
            hash_key(F.upper("x"))).first()
        assert row[0] != row[1]
        assert row[2] == hashlib.sha256(b"").hexdigest()
        assert row[3] == hashlib.sha256(b"A").hexdigest()

    def test_typed_parts(self, spark):
        df = spark.sql("select cast(4.5 as decimal(18,2)) d, 4D f, date'2021-03-05' t, 7 i")
        expected = hashlib.sha256(b"4.50||4.0||2021-03-05||7").hexdigest()
        row = df.select(hash_key("d", "f", "t", "i"), hash_cleaned("d", "f", "t", "i")).first()
        assert tuple(row) == (expected, expected)

    def test_date_key(self, spark):
        df = spark.sql("select date'2021-03-05' d union all select cast(null as date)")
        keys = df.select(date_key("d").alias("k"))
        assert keys.schema["k"].dataType == T.IntegerType()
        assert {r[0] for r in keys.collect()} == {20210305, None}


def test_null_fill(spark):
    schema = """a string, b tinyint, c smallint, d int, e bigint, f float, g double,
        h decimal(18,2), i boolean, j date, k timestamp"""
    filled = null_fill(spark.createDataFrame([(None,) * 11], schema))
    assert list(filled.first())[:9] == ["", 0, 0, 0, 0, 0.0, 0.0, Decimal("0.00"), False]
    assert list(filled.first())[9:] == [None, None]
    assert [f.dataType for f in filled.schema] == [
        f.dataType for f in spark.createDataFrame([], schema).schema]
    assert [f.nullable for f in filled.schema] == [False] * 9 + [True] * 2
    kept = null_fill(spark.sql("select double('nan') x, 'v' y, true z"))
    assert str(kept.first()[0]) == "nan" and kept.first()[1:] == ("v", True)


def test_mean_rounds_half_up_exactly(spark):
    rows = [("10.00", 3, 3.33), ("0.01", 2, 0.01), ("0.03", 2, 0.02), ("-0.01", 2, -0.01),
            ("-10.00", 3, -3.33), ("0.00", 5, 0.0),
            ("99999999999999999999999.99", 3, 33333333333333333333333.33)]
    df = spark.createDataFrame(
        [(Decimal(s), n, e) for s, n, e in rows[:-1]], "s decimal(38,2), n bigint, e double")
    for got, expected in df.select(mean_in_cents(F.col("s"), F.col("n")), "e").collect():
        assert got == expected
    none = spark.sql("select cast(null as decimal(38,2)) s, 0L n")
    assert none.select(mean_in_cents(F.col("s"), F.col("n"))).first()[0] is None
