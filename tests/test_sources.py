import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from tallystar.plans.columns import RAW_COLUMNS
from tallystar.session import build_session, setting
from tallystar.sources import (
    CatalogStore,
    FolderStore,
    HexSplit,
    JdbcStore,
    JdbcTarget,
    QuantileSplit,
    RangeSplit,
    create_namespace,
    in_storage_order,
    read_jdbc,
    read_raw_csv,
    read_split_csv,
    write_jdbc,
)
from tallystar.sources.csv_folder import RAW_SCHEMA

HEADER = ",".join(RAW_COLUMNS)


def line(**values):
    return ",".join(values.get(name, "") for name in RAW_COLUMNS)


class TestCsv:
    def test_quotes_and_line_breaks(self, spark, tmp_path):
        (tmp_path / "a.csv").write_text("\n".join([
            HEADER,
            line(id="1", product_description='"two\nlines, ""quoted"""', store_email="last"),
            line(id="2", product_description=" kept "),
        ]) + "\n")
        rows = read_raw_csv(spark, str(tmp_path)).orderBy("id").collect()
        assert [r.id for r in rows] == ["1", "2"]
        assert rows[0].product_description == 'two\nlines, "quoted"'
        assert rows[0].store_email == "last"
        assert rows[1].product_description == " kept "

    def test_columns_go_by_position(self, spark, tmp_path):
        (tmp_path / "a.csv").write_text(HEADER.replace("id,", "other,", 1) + "\n" + line(id="7"))
        assert read_raw_csv(spark, str(tmp_path)).first().id == "7"

    def test_every_top_level_file(self, spark, tmp_path):
        for name in ("b.csv", "a.csv", "skip.txt"):
            (tmp_path / name).write_text(HEADER + "\n" + line(id=name) + "\n")
        (tmp_path / "deeper").mkdir()
        (tmp_path / "deeper" / "c.csv").write_text(HEADER + "\n" + line(id="c") + "\n")
        for multi_line in (True, False):
            rows = read_raw_csv(spark, str(tmp_path), multi_line).collect()
            assert sorted(r.id for r in rows) == ["a.csv", "b.csv"]

    @pytest.mark.parametrize("bad", ["1,2", line(id="1") + ",extra"])
    def test_a_bad_file_stops_the_read(self, spark, tmp_path, bad):
        (tmp_path / "a.csv").write_text(HEADER + "\n" + line(id="1") + "\n" + bad + "\n")
        for multi_line in (True, False):
            df = read_raw_csv(spark, str(tmp_path), multi_line)
            with pytest.raises(Py4JJavaError, match="FAILED_READ_FILE"):
                df.collect()
            with pytest.raises(Py4JJavaError, match="FAILED_READ_FILE"):
                df.select("id").collect()
            with pytest.raises(Py4JJavaError, match="FAILED_READ_FILE"):
                df.count()


class TestStores:
    def test_folder(self, spark, tmp_path):
        store = FolderStore(spark, str(tmp_path))
        df = spark.range(100).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id")
        store.write(df, "t", ("k",))
        store.write(df, "t", ("k",))
        assert store.read("t").count() == 100
        store.write(df, "t", mode="append")
        assert store.read("t").count() == 200

    def test_storage_order(self, spark):
        df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
        stretches = (
            in_storage_order(df, ["k"])
            .withColumn("place", F.monotonically_increasing_id())
            .groupBy(F.spark_partition_id().alias("part"))
            .agg(F.min("k").alias("low"), F.max("k").alias("high"),
                 F.corr(F.col("k").cast("double"), F.col("place").cast("double")).alias("c"))
            .orderBy("low").collect()
        )
        for first, second in zip(stretches, stretches[1:]):
            assert first.high < second.low
        assert in_storage_order(df, []) is df

    def test_catalog(self, spark):
        create_namespace(spark, "dwh")
        create_namespace(spark, "dwh")
        store = CatalogStore(spark, "dwh")
        for _ in range(2):
            store.write(spark.range(3), "t")
        assert store.read("t").count() == 3
        assert spark.catalog.tableExists("dwh.t")


class TestJdbc:
    """What is asked of Spark's JDBC source; no database is started for it."""

    target = JdbcTarget("jdbc:x://host/db", "me", "pw", "org.x.Driver")

    @pytest.fixture
    def asked(self, monkeypatch):
        seen = {}

        def options(self, **given):
            seen.update(given)
            return self

        for cls in (DataFrameReader, DataFrameWriter):
            monkeypatch.setattr(cls, "options", options)
            monkeypatch.setattr(
                cls, "format", lambda self, source: seen.update(format=source) or self)
        monkeypatch.setattr(DataFrameWriter, "mode", lambda s, m: seen.update(mode=m) or s)
        monkeypatch.setattr(
            DataFrameWriter, "option", lambda s, k, v: seen.update({k: v}) or s)
        monkeypatch.setattr(
            DataFrameWriter, "save",
            lambda s: seen.update(parts=s._df.rdd.getNumPartitions()))
        monkeypatch.setattr(DataFrameReader, "load", lambda s: seen)
        monkeypatch.setattr(DataFrameReader, "jdbc", lambda s, *a, **k: seen.update(a=a, **k))
        return seen

    def test_from_env(self):
        env = {"DB_JDBC_URL": "jdbc:y", "DB_USER": "u"}
        target = JdbcTarget.from_env("DB", "d", env, url="jdbc:z", password="p")
        assert target == JdbcTarget("jdbc:y", "u", "p", "d")

    def test_whole_table_scan(self, spark, asked):
        read_jdbc(spark, self.target, "dwh.t")
        assert asked == {"format": "jdbc", "url": "jdbc:x://host/db", "user": "me",
                         "password": "pw", "driver": "org.x.Driver", "dbtable": "dwh.t",
                         "fetchsize": "10000"}

    def test_range_scan(self, spark, asked):
        read_jdbc(spark, self.target, "t", RangeSplit("date_key", "20200101", "20220101", 8))
        assert asked["partitionColumn"] == "date_key" and asked["numPartitions"] == 8
        assert (asked["lowerBound"], asked["upperBound"]) == ("20200101", "20220101")

    def test_key_scan(self, spark, asked):
        read_jdbc(spark, self.target, "t", HexSplit("sale_key", 4))
        assert asked["a"] == ("jdbc:x://host/db", "t")
        assert asked["properties"]["fetchsize"] == "10000"
        assert asked["predicates"] == [
            "(sale_key < '4000' OR sale_key IS NULL)",
            "sale_key >= '4000' AND sale_key < '8000'",
            "sale_key >= '8000' AND sale_key < 'c000'",
            "sale_key >= 'c000'",
        ]

    @pytest.mark.parametrize("parts", [1, 3, 16, 100])
    def test_every_key_is_in_one_part(self, spark, parts):
        df = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
        df = df.union(spark.sql("select cast(null as string)"))
        hits = sum((F.expr(f"coalesce({p}, false)").cast("int")
                    for p in HexSplit("k", parts).predicates()), F.lit(0))
        assert df.where(hits != 1).count() == 0

    def test_write(self, spark, asked, monkeypatch):
        df = spark.range(100).repartition(6)
        write_jdbc(df, self.target, "t")
        assert asked["mode"] == "overwrite" and asked["dbtable"] == "t"
        assert asked["parts"] == 6 and "createTableOptions" not in asked
        write_jdbc(df, self.target, "t", "append", partitions=2)
        assert (asked["mode"], asked["parts"]) == ("append", 2)
        monkeypatch.setenv("JDBC_WRITE_PARTITIONS", "1")
        write_jdbc(df, self.target, "t")
        assert asked["parts"] == 1

    def test_store_passes_the_storage_order(self, spark, asked):
        store = JdbcStore(spark, self.target, "analytics", table_options="ORDER BY ({order})")
        store.write(spark.range(3), "report", ("year", "month"))
        assert asked["createTableOptions"] == "ORDER BY (year, month)"
        assert asked["dbtable"] == "analytics.report"


def test_settings(spark):
    assert setting("NAME", "default", {}) == "default"
    assert setting("NAME", "default", {"NAME": "given"}) == "given"


def test_session_takes_its_settings_from_the_environment(monkeypatch):
    asked = {}

    class Builder:
        def appName(self, name):
            asked["name"] = name
            return self

        def master(self, url):
            asked["master"] = url
            return self

        def config(self, map):
            asked.update(map)
            return self

        def getOrCreate(self):
            return self

        @property
        def sparkContext(self):
            return self

        def setLogLevel(self, level):
            asked["level"] = level

    monkeypatch.setattr("tallystar.session.SparkSession.builder", Builder())
    build_session("job", {"spark.a": "b", "spark.sql.adaptive.enabled": "false"}, {
        "SPARK_MASTER_URL": "local[2]", "SPARK_TIMEZONE": "Asia/Tokyo",
        "SPARK_LOG_LEVEL": "ERROR", "SPARK_JDBC_CLASSPATH": "/jars/x.jar"})
    assert (asked["name"], asked["master"], asked["level"]) == ("job", "local[2]", "ERROR")
    assert asked["spark.sql.session.timeZone"] == "Asia/Tokyo"
    assert asked["spark.executor.extraClassPath"] == "/jars/x.jar"
    assert "spark.driver.extraClassPath" not in asked
    assert int(asked["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 2000
    assert asked["spark.a"] == "b" and asked["spark.sql.adaptive.enabled"] == "false"
    asked.clear()
    build_session("job", {"spark.sql.shuffle.partitions": "8"}, {})
    assert "spark.sql.adaptive.coalescePartitions.initialPartitionNum" not in asked
    build_session("job", None, {})
    assert (asked["master"], asked["spark.sql.session.timeZone"]) == ("local[*]", "UTC")


def test_quantile_split_covers_each_row_once_in_even_parts(spark):
    """Half of the rows share one value, some have nulls."""
    rng = random.Random(6)
    rows = [(None if i % 50 == 0 else 7 if rng.random() < 0.5 else int(rng.paretovariate(0.7)) % 10**6,
             None if i % 70 == 0 else f"k'{rng.randrange(10**6):06d}") for i in range(8000)]
    table = spark.createDataFrame(rows, "a long, key string")
    split = QuantileSplit.of_sample(table.sample(0.25, seed=1), "a", "key", 8)
    predicates = split.predicates()
    assert len(predicates) == 8
    counts = [table.where(p).count() for p in predicates]
    assert sum(counts) == 8000 and max(counts) <= 2 * 1000
    held = sum((F.expr(f"({p})").eqNullSafe(F.lit(True))).cast("int") for p in predicates)
    assert table.where(held != 1).count() == 0
    assert QuantileSplit.of_sample(table.limit(0), "a", "key", 4).predicates() == ["1 = 1"]


def test_a_lookup_reads_the_files_that_can_hold_the_key(spark, settings, tmp_path):
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    store = FolderStore(spark, f"{tmp_path}/lake")
    rows = spark.range(4000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("key"), (F.col("id") % 5).alias("b"), "id")
    store.write(rows, "t", order=("key", "b"))
    assert len(store.read("t").inputFiles()) > 2
    for n in (0, 17, 3999):
        (key,) = rows.where(F.col("id") == n).select("key").first()
        found = store.find("t", key=key, b=n % 5)
        assert [r.id for r in found.collect()] == [n] and len(found.inputFiles()) == 1
    assert store.find("t", key="~").count() == 0
    assert store.find("t", b=3).count() == 800  # not a leading column: all files


def test_split_csv_equals_whole_files(spark, settings, tmp_path):
    rng = random.Random(2)
    values = ["", "plain", 'say ""hi""', "two\nlines", "a\n\nb", "comma, inside", '""', "é\n"]
    width = len(RAW_SCHEMA)
    for part in range(2):
        with open(tmp_path / f"p{part}.csv", "w", newline="") as file:
            file.write(",".join(RAW_SCHEMA.names) + "\n")
            for _ in range(150):
                file.write(",".join(
                    f'"{rng.choice(values)}"' if rng.random() < 0.5 else str(rng.randrange(99))
                    for _ in range(width)) + "\n")
    whole = sorted(map(str, read_raw_csv(spark, str(tmp_path)).collect()))
    settings("spark.sql.files.maxPartitionBytes", "9000")
    settings("spark.sql.files.openCostInBytes", "0")
    split = read_split_csv(spark, str(tmp_path))
    assert sorted(map(str, split.collect())) == whole and len(whole) == 300
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 6
    assert split.schema == RAW_SCHEMA


def test_split_csv_stops_at_a_bad_record(spark, raw, tmp_path):
    names = ",".join(RAW_SCHEMA.names)
    (tmp_path / "bad.csv").write_text(f"{names}\n1,2,3\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_split_csv(spark, str(tmp_path)).collect()
