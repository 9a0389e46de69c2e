"""Near-duplicates by HyperMinHash sketches, banding and exact verification.

Each distinct shingle falls into one of 128 buckets by its hash. A bucket keeps its
smallest hash as a count of leading zeros and a few bits of mantissa, 16 bits in all.
Empty buckets borrow from full ones in an order fixed by hash, so that short texts too
agree in each register with the chance of their similarity. Documents that agree on a
whole band of registers are candidates; with 32 bands of 4 a pair at similarity 0.8 is
missed once in twenty million. A second, finer sketch of 1024 registers of 8 bits, in
which empty buckets stay empty, serves to estimate similarity; it holds most shingles of
an ordinary text, so its error is about 0.01.

Equal sets are merged first. Then every band bucket links its members to its smallest:
a bucket of m members gives m - 1 pairs, not m * m / 2. Pairs whose similarity, estimated
from the fine registers and corrected for chance collisions, is too low by several times
that error are dropped, the others are confirmed on their full sets. Only buckets whose
members then are in different groups are compared in full, sketch by sketch and in
blocks; of these too only pairs with a likely similarity leave the task, to be confirmed.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.blocks import (
    LOWER, VISIBLE, Block, blocks, column_of, mixed, shingle_hashes, word_hashes,
)
from tallystar.llm.shared import dropped, packed, unpacked, written

SHINGLE = 5
PERCENT = 80
REGISTERS = 128
BAND = 4
MANTISSA = 10
FINE_REGISTERS = 1024
FINE_MANTISSA = 5
MARGIN = 0.06
BLOCK_MEMBERS = 1024

_LAST_EXPONENT = np.uint64(1023 + 63)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def distinct_shingles(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document and the bounds of each."""
    starts, ends, bounds = block.words(VISIBLE)
    found, owner = shingle_hashes(word_hashes(LOWER[block.data], starts, ends), bounds, size)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    if len(found):
        fresh = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1]))
        found, owner = found[fresh], owner[fresh]
    return found, np.searchsorted(owner, np.arange(len(block) + 1))


def _minima(found: np.ndarray, bounds: np.ndarray, count: int, mantissa_bits: int, most: int):
    """For each document's full buckets of ``count``: the bucket's place, and leading zeros
    (at most ``most``) and mantissa of its smallest hash in one number."""
    bits = np.uint64(count.bit_length() - 1)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    slot = owner * count + (found >> (np.uint64(64) - bits)).astype(np.int64)
    if len(slot):
        smallest = np.append(True, slot[1:] != slot[:-1])  # sorted: the first is the least
        slot, found = slot[smallest], found[smallest]
    rest = ((found << bits) | np.uint64(1)).astype(np.float64).view(np.uint64)
    zeros = _LAST_EXPONENT - np.minimum(rest >> np.uint64(52), _LAST_EXPONENT)
    mantissa = (rest >> np.uint64(52 - mantissa_bits)) & np.uint64((1 << mantissa_bits) - 1)
    return slot, (np.minimum(zeros, np.uint64(most)) << np.uint64(mantissa_bits)) | mantissa


def registers(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of 128 registers for each document; zeros where there are no shingles."""
    slot, minima = _minima(found, bounds, REGISTERS, MANTISSA, 63)
    rows = np.zeros((len(bounds) - 1, REGISTERS), np.uint16)
    full = np.zeros(rows.shape, bool)
    rows.ravel()[slot] = minima.astype(np.uint16)
    full.ravel()[slot] = True
    row, column = np.nonzero(~full & full.any(axis=1)[:, None])
    turn = 0
    while len(row):
        lender = (mixed((column + turn * REGISTERS + 1).astype(np.uint64))
                  % np.uint64(REGISTERS)).astype(np.int64)
        found_one = full[row, lender]
        rows[row[found_one], column[found_one]] = rows[row[found_one], lender[found_one]]
        row, column, turn = row[~found_one], column[~found_one], turn + 1
    return rows


def fine_registers(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of 1024 registers for each document; 0 is an empty bucket."""
    slot, minima = _minima(found, bounds, FINE_REGISTERS, FINE_MANTISSA, 6)
    rows = np.zeros((len(bounds) - 1, FINE_REGISTERS), np.uint8)
    rows.ravel()[slot] = (minima + np.uint64(1)).astype(np.uint8)
    return rows


def estimate(ours: np.ndarray, theirs: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity from fine registers. Buckets full on both sides agree by chance too; that
    chance follows from the sizes and the mantissa bits and is taken off."""
    agree = ((ours == theirs) & (theirs > 0)).sum(axis=1)
    either = ((ours | theirs) > 0).sum(axis=1)
    both = (ours > 0).sum(axis=-1) + (theirs > 0).sum(axis=1) - either
    chance = np.log(2) / (1 << FINE_MANTISSA) * n_a * n_b / (n_a + n_b) ** 2
    return np.maximum(agree - chance * both, 0) / (1 - chance) / np.maximum(either, 1)


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text), ``n_shingles``, a 128-bit digest of the set of
    shingles (``high``, ``low``), and ``registers`` and ``fine`` registers of every row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            digests = np.zeros((2, batch.num_rows), np.uint64)
            sketched, fine = [b""] * batch.num_rows, [b""] * batch.num_rows
            for block in blocks(column_of(batch, "text")):
                found, bounds = distinct_shingles(block, size)
                rows = slice(block.first, block.first + len(block))
                counts[rows] = np.diff(bounds)
                for k, values in enumerate((found, mixed(found ^ _SECOND))):
                    total = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
                    digests[k, rows] = total[bounds[1:]] - total[bounds[:-1]]
                sketched[rows] = [row.tobytes() for row in registers(found, bounds)]
                fine[rows] = [row.tobytes() for row in fine_registers(found, bounds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(counts),
                 pa.array(digests[0].view(np.int64)), pa.array(digests[1].view(np.int64)),
                 pa.array(sketched, pa.binary()), pa.array(fine, pa.binary())],
                ["doc_id", "mark", "n_shingles", "high", "low", "registers", "fine"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(
        sketch, f"doc_id {kind}, mark long, n_shingles long, high long, low long, "
                "registers binary, fine binary")


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _bands(classes: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = REGISTERS // BAND
        for batch in batches:
            keys = _matrix(column_of(batch, "registers"), np.uint16, REGISTERS).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(count, dtype=np.int32), len(keys))),
                 pa.array(keys.ravel()),
                 pa.array(np.repeat(column_of(batch, "node").to_numpy(), count))],
                ["band", "key", "node"])

    return classes.select("node", "registers").mapInArrow(cut, "band int, key long, node long")


def _likely(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs ``a``, ``b`` whose estimated similarity is not far below what is asked."""
    ours = classes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"),
                          F.col("fine").alias("r_a"))
    theirs = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"),
                            F.col("fine").alias("r_b"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                guess = estimate(
                    *(_matrix(column_of(batch, n), np.uint8, FINE_REGISTERS) for n in ("r_a", "r_b")),
                    *(column_of(batch, n).to_numpy().astype(float) for n in ("n_a", "n_b")))
                yield batch.select(["a", "b"]).filter(pa.array(guess >= least))

    # One plan at every size: pairs are never sent to all tasks.
    sized = pairs.hint("merge").join(ours, "a").hint("merge").join(theirs, "b")
    return sized.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(judge, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets share at least ``percent`` hundredths of their union."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [[], []]
            for own, name in zip(sets, ("text_a", "text_b"), strict=True):
                for block in blocks(column_of(batch, name)):
                    found, bounds = distinct_shingles(block, size)
                    own += [found[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
            linked = []
            for x, y in zip(*sets, strict=True):
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    joined = (
        pairs.hint("merge")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .hint("merge").join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    )
    return joined.mapInArrow(judge, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest ``component`` node it is connected to, for all nodes of
    ``edges`` (``a``, ``b``). Every round each node joins its smallest neighbour and the
    groups shrink to single nodes, so that the number of rounds grows with the logarithm."""
    edges = written(edges.select("a", "b"), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p"))
        parent = written(parent, "parents")
        for _ in range(2):
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
            parent = parent.join(up, "p").select("a", F.col("q").alias("p"))
        parent = written(parent, "parents")
        if labels is None:
            labels = parent.select(F.col("a").alias("node"), F.col("p").alias("component"))
        else:
            labels = labels.join(
                parent.select(F.col("a").alias("component"), "p"), "component", "left").select(
                "node", F.coalesce("p", "component").alias("component"))
        labels = written(labels, "labels")
        a = parent.select("a", F.col("p").alias("p_a"))
        b = parent.select(F.col("a").alias("b"), F.col("p").alias("p_b"))
        edges = written(
            edges.join(a, "a").join(b, "b").filter("p_a <> p_b").select(
                F.least("p_a", "p_b").alias("a"), F.greatest("p_a", "p_b").alias("b")).distinct(),
            "edges")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def _across(bands: DataFrame, classes: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """Likely pairs of members of the same band bucket that are in different groups. A pair
    that meets in several bands comes from the first of them."""
    grouped = bands.join(labels, "node", "left").select(
        "band", "key", "node", F.coalesce("component", "node").alias("component"))
    mixed_buckets = grouped.groupBy("band", "key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.count("*").alias("members")).filter("low <> high").drop("low", "high")
    members = grouped.join(mixed_buckets, ["band", "key"]).withColumn(
        "parts", F.ceil(F.col("members") / BLOCK_MEMBERS).cast("int")).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = members.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).select(
        "band", "key", "node", "component", "part",
        F.least("part", "other").alias("block_a"), F.greatest("part", "other").alias("block_b"))
    dealt = dealt.join(classes.select("node", "n_shingles", "registers", "fine"), "node")

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node, group, part = (
            column_of(table, name).to_numpy() for name in ("node", "component", "part"))
        rows = _matrix(column_of(table, "fine"), np.uint8, FINE_REGISTERS)
        sizes = column_of(table, "n_shingles").to_numpy().astype(float)
        bands = _matrix(column_of(table, "registers"), np.uint16, REGISTERS).view(np.int64)
        earlier = bands[:, :key[0].as_py()]
        first, second = key[2].as_py(), key[3].as_py()
        pairs = []
        for i in np.flatnonzero(part == first):
            others = np.flatnonzero(
                (part == second) & (group != group[i]) & ((node > node[i]) | (first != second))
                & (sizes >= least * sizes[i]) & (sizes[i] >= least * sizes))
            if len(others):
                guess = estimate(rows[i], rows[others], sizes[i], sizes[others])
                close = others[guess >= least]
                close = close[~(earlier[close] == earlier[i]).any(axis=1)]
                pairs.append(np.column_stack([np.full(len(close), node[i]), node[close]]))
        found = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
        return pa.table({"a": found.min(axis=1) if len(found) else found[:, 0],
                         "b": found.max(axis=1) if len(found) else found[:, 1]})

    return dealt.groupBy("band", "key", "block_a", "block_b").applyInArrow(
        compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text), ``n_shingles``, ``component_id`` and ``kept``
    of every row.

    Documents are linked if their sets of ``size``-word shingles share at least ``percent``
    hundredths of their union; a text of fewer words is one shingle. The component id is
    the smallest doc_id that links lead to; ``kept`` marks the row with that id. Null texts
    and texts without words are linked with nothing. Repeated rows are copies of each
    other. Rows without an id follow their copies that have one, and are linked with
    nothing else. Different texts under one id that is the least of its copies are one node:
    what links to one of them links to all. ``doc_id`` is a long; other columns are not read.
    """
    least = percent / 100 - MARGIN
    sketched = written(sketches(docs, size), "sketches")
    classes = sketched.filter("n_shingles > 0 and doc_id is not null").groupBy(
        "high", "low", "n_shingles").agg(
        F.min("doc_id").cast("long").alias("node"), F.first("registers").alias("registers"),
        F.first("fine").alias("fine"))
    classes = written(classes, "classes")
    bands = written(_bands(classes), "bands")
    leads = bands.groupBy("band", "key").agg(
        F.min("node").alias("a"), F.count("*").alias("members")).filter("members > 1")
    stars = written(
        bands.join(leads, ["band", "key"]).filter("node <> a").select(
            "a", F.col("node").alias("b")).distinct(), "stars")
    likely = written(_likely(stars, classes, least), "likely")
    members = stars.select(F.col("a").alias("node")).unionByName(
        stars.select(F.col("b").alias("node"))).distinct()
    texts = written(docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(
        members.hint("merge"), "node"), "texts")
    links = written(_confirmed(likely, texts, size, percent), "links")
    labels = components(links)
    more = written(_across(bands, classes, labels, least), "across")
    fresh = more.join(likely, ["a", "b"], "left_anti")
    more_links = written(_confirmed(fresh, texts, size, percent), "more-links")
    labels = components(links.unionByName(more_links))
    dropped(texts)
    dropped(bands)
    named = classes.join(labels, "node", "left").select(
        "high", "low", "n_shingles", F.coalesce("component", "node").alias("component"))
    joined = sketched.drop("registers", "fine").join(named, ["high", "low", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "mark", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the least
    id; of rows equal in id and text one stays. Null texts and texts without words all
    stay. Rows without an id stay if they are a copy of nothing that has one. Rows that
    share the least id of a group but not their text all stay.
    """
    found = near_duplicates(docs, size, percent).filter("kept and n_shingles > 0")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = packed(docs, doc_id=F.col("doc_id"), mark=F.xxhash64("text"), worded=worded)
    parts = [marked.filter("not worded")]
    keys = found.select(F.col("doc_id").alias("of"), F.col("mark").alias("own")).distinct()
    first = Window.partitionBy("mark", "doc_id").orderBy(F.lit(1))
    for own, match in (
        (F.col("doc_id").isNotNull(), F.col("doc_id") == F.col("of")),
        (F.col("doc_id").isNull(), F.col("of").isNull()),
    ):
        rows = marked.filter(F.col("worded") & own).join(
            keys, (F.col("mark") == F.col("own")) & match, "left_semi")
        parts.append(rows.withColumn("copy", F.row_number().over(first)).filter(
            "copy = 1").drop("copy"))
    return unpacked(reduce(DataFrame.unionByName, parts), docs.columns)
