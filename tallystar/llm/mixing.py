"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, target / source size.
Its whole part is taken outright. The fractional parts are rounded in pairs: words move
from one document of the pair to the other, in a random direction whose odds keep both
expectations, until one part is 0 or 1; the other goes on to the next pair. Each pair
keeps its words, so a source ends within one document of its target. Longer documents come
first, so that the one left over at the end is short.

A source is cut into buckets of documents. Each bucket is rounded by itself and leaves at
most one fractional document; those meet in a tree with a fan-in of ``FAN_IN`` until one
is left for each source, which is drawn by its odds. A source with a third of all rows
is just more buckets.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.blocks import column_of
from tallystar.llm.shared import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
BUCKET_ROWS = 4096
FAN_IN = 64
SEED = 17


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    most: float = MOST_COPIES,
) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``, any others).

    Sources by code point, null last, take the weights in turn and share ``share`` times
    all sizes by them. A target stops at ``most`` times its source's size; what is over
    goes to the others by weight. The level at which it stops is found by filling the
    sources in the order in which they reach their limit.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(everything) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)),
                          (place % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("_weight", weight).withColumn(
        "_limit", F.col("source_size") * float(most))
    filling = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = ranked.withColumn(
        "_level",
        (F.sum("source_size").over(whole) * float(share)
         - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0)))
        / (F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0.0))),
    )
    level = F.max("_level").over(whole)
    target = F.least(F.col("_limit"), level * F.col("_weight"))
    return ranked.withColumn("target", target).drop("_weight", "_limit", "_level")


def round_pairs(parts: np.ndarray, sizes: np.ndarray, order: np.ndarray, draws: np.ndarray):
    """Round fractional ``parts`` in place, pair by pair along ``order``.

    Returns the index of the one document that stays fractional, or -1.
    """
    held = -1
    for step, i in enumerate(order):
        if not 0.0 < parts[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b, x, y = float(sizes[held]), float(sizes[i]), float(parts[held]), float(parts[i])
        up, down = min((1.0 - x) * a, y * b), min(x * a, (1.0 - y) * b)
        if draws[step] * (up + down) < down:  # words move from i to the held one
            full = (1.0 - x) * a <= y * b
            empty = y * b <= (1.0 - x) * a
            parts[held] = 1.0 if full else x + up / a
            parts[i] = 0.0 if empty else y - up / b
        else:
            empty = x * a <= (1.0 - y) * b
            full = (1.0 - y) * b <= x * a
            parts[held] = 0.0 if empty else x - down / a
            parts[i] = 1.0 if full else y + down / b
        if not 0.0 < parts[held] < 1.0:
            held = i if 0.0 < parts[i] < 1.0 else -1
    return held


def _rounder(level: int, last: bool, seed: int):
    """Round one bucket; a row that stays fractional keeps its part, others get 0 or 1."""

    def apply(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = column_of(table, "part").to_numpy(zero_copy_only=False).copy()
        sizes = column_of(table, "size").to_numpy(zero_copy_only=False)
        marks = column_of(table, "mark").to_numpy(zero_copy_only=False)
        order = np.lexsort((marks, -sizes))
        source = key[0].as_py()
        name = f"{seed}|{level}|{key[1].as_py()}|{source is None}|{source}".encode()
        draws = np.random.default_rng(list(name)).random(len(order) + 1)
        held = round_pairs(parts, sizes, order, draws)
        if held >= 0 and last:
            parts[held] = float(draws[-1] < parts[held])
        return table.set_column(
            table.schema.get_field_index("part"), "part", pa.array(parts, pa.float64()))

    return apply


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``copy``: rows with equal ``mark`` are numbered from 0. They are counted where they
    were read first, so that no task sees all copies of a row."""
    repeated = written(rows.groupBy("mark").agg(F.count("*").alias("n")).where(
        "n > 1").select("mark"), "mix-repeated")
    if repeated.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    here = F.shiftright("place", 33).alias("part")  # which task numbered the row
    few = rows.join(repeated, "mark", "left_semi").withColumn("part", here)
    earlier = Window.partitionBy("mark").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = few.groupBy("mark", "part").agg(F.count("*").alias("n")).select(
        "mark", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("mark", "part").orderBy("place")
    counted = few.withColumn("within", F.row_number().over(own) - 1).join(
        before, ["mark", "part"]).withColumn("copy", F.col("before") + F.col("within"))
    return rows.join(repeated, "mark", "left_anti").withColumn(
        "copy", F.lit(0).cast("long")).unionByName(counted.drop("part", "before", "within"))


def mix(
    docs: DataFrame, size: Column, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    most: int = MOST_COPIES, seed: int = SEED,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` (the source's) and ``copies`` to ``docs``.

    ``docs`` needs ``source``; other columns are carried along. No document gets more
    than ``most`` copies. Documents of size 0 are drawn one by one. A null source is a
    source of its own. Order and draws hang on the rows' contents, so reruns agree; equal
    rows are drawn separately and may differ. No rows give no rows.

    Only sizes and sources go through the rounding; texts wait in a written table.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    held = written(docs.select(
        F.struct(*own).alias("row"), "source",
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), *own).alias("mark"),
        F.monotonically_increasing_id().alias("place")), "mix-rows")
    rows = _numbered(held.select("place", "source", "size", "mark")).withColumn(
        "mark", F.xxhash64("mark", "size", "copy")).drop("copy")
    sources = written(source_targets(
        rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")),
        weights, share, most).withColumn(
        "buckets", F.ceil(F.col("rows") / BUCKET_ROWS).cast("long")), "mix-sources")
    most_buckets = sources.agg(F.max("buckets")).first()[0] or 1
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    table = sources.withColumn("rate", rate).withColumnRenamed("source", "of").drop("rows")
    chance = F.col("rate") - F.floor("rate")
    uniform = F.pmod(F.xxhash64(F.lit("empty"), F.lit(seed), "mark"), F.lit(1 << 30)) / (1 << 30)
    rows = (
        rows.join(table, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("part", F.when(F.col("size") > 0, chance).otherwise(
            (uniform < chance).cast("double")))
        .withColumn("bucket", F.pmod(F.xxhash64(F.lit("bucket"), "mark"), F.col("buckets")))
        .select("place", "source", "size", "mark", "part", "bucket", "rate", "source_size", "target")
    )
    last = most_buckets == 1
    rounded = written(
        rows.groupBy("source", "bucket").applyInArrow(_rounder(0, last, seed), rows.schema), "mix")
    if not last:
        left = rounded.filter("part > 0 and part < 1").select(
            "source", "bucket", "part", "size", F.col("bucket").alias("node"),
            F.col("bucket").alias("mark"))
        done, levels = None, max(1, math.ceil(math.log(most_buckets, FAN_IN) - 1e-9))
        for level in range(1, levels + 1):
            left = left.withColumn("node", F.floor(F.col("node") / FAN_IN))
            left = written(left.groupBy("source", "node").applyInArrow(
                _rounder(level, level == levels, seed), left.schema), f"mix-level{level}")
            whole = left.filter("not (part > 0 and part < 1)")
            done = whole if done is None else done.unionByName(whole)
            left = left.filter("part > 0 and part < 1")
        settled = done.select(F.col("source").alias("of"), F.col("bucket").alias("in_bucket"),
                              F.col("part").alias("settled"))
        rounded = rounded.join(
            settled,
            F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in_bucket"))
            & (F.col("part") > 0) & (F.col("part") < 1), "left",
        ).withColumn("part", F.coalesce("settled", "part"))
    copies = rounded.select(
        "place", "source_size", "target",
        (F.floor("rate") + F.round("part")).cast("long").alias("copies"))
    return held.drop("source").join(copies, "place").select(
        *(F.col("row").getField(c).alias(c) for c in own), "size", "source_size", "target", "copies")
