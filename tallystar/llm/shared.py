"""Tables in the folder that driver and executors share, and joins that keep user columns
apart."""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.operators.workspace import remove, scratch_folder


# All ASCII but small letters and digits, which separates lower-case words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_words(text: Column) -> Column:
    """Lower-case words of letters and digits; none for null. Cutting at what separates them
    is several times cheaper than looking for what they are made of."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def written(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a table in the shared run folder and read it back.

    This cuts the lineage: what is read later survives lost executors, and steps that
    read it twice do not compute it twice. The folder goes at the end of the run.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` returned and nothing reads any more."""
    for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        remove(df.sparkSession, path)


def packed(df: DataFrame, **extra: Column) -> DataFrame:
    """All columns of ``df`` in one struct, ``row``, beside the columns given: whatever a
    user's columns are called, they meet none of ours."""
    return df.select(F.struct("*").alias("row"), *(c.alias(name) for name, c in extra.items()))


def unpacked(df: DataFrame, columns: Sequence[str], **changed: Column) -> DataFrame:
    """The user's columns again, some of them with another value."""
    return df.select(*(changed.get(name, F.col("row").getField(name)).alias(name)
                       for name in columns))


def keyed(df: DataFrame, other: DataFrame, keys: Sequence[str] | Mapping[str, Column],
          how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` with (or without: ``left_anti``) a row of ``other`` equal in all keys,
    null to null. ``keys`` are columns of both, or expressions over ``df`` by the names that
    ``other`` has for them."""
    own = keys if isinstance(keys, Mapping) else {name: F.col(name) for name in keys}
    left = packed(df, **{f"key_{i}": c for i, c in enumerate(own.values())})
    right = other.select(*(F.col(name).alias(f"of_{i}") for i, name in enumerate(own)))
    match = reduce(and_, (F.col(f"key_{i}").eqNullSafe(F.col(f"of_{i}")) for i in range(len(own))))
    return unpacked(left.join(right, match, how), df.columns)


def once(rows: DataFrame, keys: Mapping[str, Column]) -> tuple[DataFrame, Callable]:
    """``rows`` with those that agree in all ``keys`` once, the keys and ``times`` added; and
    what gives rows with the keys back as often as they came.

    Only rows that repeat are moved, and they are combined before; so a row that is a third
    of a table is no hot key later.
    """
    names = list(keys)
    # With expressions in place, columns of the same name stay as they are.
    named = rows.withColumns({name: value for name, value in keys.items()})
    repeated = written(named.groupBy(*names).agg(F.count("*").alias("times")).where(
        "times > 1"), "repeated")
    if repeated.isEmpty():
        return named.withColumn("times", F.lit(1).cast("long")), lambda df: df
    match = reduce(and_, (F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in names))
    of = repeated.withColumnsRenamed({name: f"of_{name}" for name in names})
    few = named.join(of, match).drop(*(f"of_{name}" for name in names)).dropDuplicates(names)
    single = named.join(of, match, "left_anti").withColumn("times", F.lit(1).cast("long"))

    def again(df: DataFrame) -> DataFrame:
        counted = df.join(of, match, "left")
        return counted.withColumn("copy", F.explode(F.sequence(
            F.lit(1).cast("long"), F.coalesce("times", F.lit(1).cast("long"))))).drop(
            "copy", "times", *(f"of_{name}" for name in names))

    return single.unionByName(few), again
