"""Operators that carry user columns along: names that clash, rows that repeat."""
import random

import pytest
from pyspark.sql import functions as F

from tallystar.llm import cotraining, hyperminhash, merkle, mixing, suffix_array

NAMES = {
    "one_of_each": ("_own", "_id", "_copy", "_mark", "row", "mark", "own", "of", "copy", "worded"),
    "mix": ("_size", "_source", "_mark", "_bucket", "row", "place", "mark", "part", "bucket", "of",
            "copy", "rate", "rows", "node", "n", "buckets", "_weight", "_limit", "_level"),
    "with_next": ("_b", "_mark", "_bucket", "_head", "_top", "_first", "row"),
    "score_quality": ("_source", "_lang", "_row", "row", "views", "quality", "logit", "view"),
}


def corpus():
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(n))
    rows = [(i, text(30 + i), f"s{i % 2}") for i in range(24)]
    return rows + [(30, rows[3][1], "s1"), (31, None, "s0"), (32, "", None), (None, text(9), "s0")]


def apply(name, docs, labels):
    if name == "one_of_each":
        return hyperminhash.one_of_each(docs)
    if name == "mix":
        return mixing.mix(docs, mixing.word_count(F.col("text")))
    if name == "with_next":
        return merkle.with_next(docs)
    return cotraining.score_quality(docs, labels)


@pytest.mark.parametrize("name", NAMES)
def test_clashing_names(spark, documents, monkeypatch, name):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)],
                                   "doc_id long, quality int, toxic int")
    plain = apply(name, documents(corpus()), labels)
    extra = documents(corpus()).withColumns({n: F.lit(f"user {n}") for n in NAMES[name]})
    got = apply(name, extra, labels)
    assert set(got.columns) == set(plain.columns) | set(NAMES[name])
    assert got.columns[:len(extra.columns)] == extra.columns
    rows = got.collect()
    for row in rows:
        assert all(row[n] == f"user {n}" for n in NAMES[name])
    kept = [c for c in plain.columns if name != "mix" or c != "copies"]  # drawn by all columns
    assert sorted(str([r[c] for c in kept]) for r in rows) == sorted(
        str([r[c] for c in kept]) for r in plain.collect())


def test_a_row_that_is_a_third_of_the_table_is_mixed_in_many_buckets(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rows = [(i, "w " * (1 + i % 9), f"s{i % 3}") for i in range(600)] + [(9, "w w w", "s0")] * 400
    docs = documents(rows).repartition(7)
    size = mixing.word_count(F.col("text"))
    got = mixing.mix(docs, size)
    taken = got.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"),
        F.count("*").alias("n")).collect()
    assert sum(r.n for r in taken) == 1000
    assert all(abs(r.taken - r.target) <= 9 for r in taken)
    copies = {r.copies for r in got.filter("doc_id = 9").collect()}
    assert len(copies) > 1
    again = mixing.mix(documents(rows[::-1]).repartition(3), size)
    shown = [sorted(map(str, df.collect())) for df in (got, again)]
    assert shown[0] == shown[1]


def test_copies_are_numbered_over_all_tasks(documents):
    rows = documents([(1, "a")] * 300 + [(2, "b")] * 5 + [(3, "c")]).repartition(6).select(
        F.monotonically_increasing_id().alias("place"), F.col("doc_id").alias("mark"))
    got = mixing._numbered(rows).groupBy("mark").agg(F.sort_array(F.collect_list("copy")).alias("n"))
    assert {r.mark: r.n for r in got.collect()} == {
        1: list(range(300)), 2: list(range(5)), 3: [0]}


def test_repeated_rows_of_op5_come_back(documents, monkeypatch):
    monkeypatch.setattr(suffix_array, "CHUNK_BYTES", 2000)
    rows = [(1, "p" * 60), (2, "a" + "p" * 55 + "b"), (None, None)]
    docs = documents(rows + [rows[1]] * 40 + [rows[2]] * 3)
    got = sorted(map(str, suffix_array.remove_repeats(docs).collect()))
    alone = {str(r) for r in suffix_array.remove_repeats(documents(rows)).collect()}
    assert len(got) == 46 and set(got) == alone


def test_surest_documents_against_sorting(spark, documents):
    """The sweep finds what sorting all documents by either view finds."""
    rows = [(i, r[1], r[2]) for i, r in enumerate(corpus() * 6)] + [(7, corpus()[7][1], "s1")] * 9
    table = cotraining.described(documents(rows).repartition(5)).withColumn(
        "quality", F.lit(None).cast("int"))
    every = table.toArrow()
    features = cotraining._matrix(every)
    spread = features.std(axis=0) > 0
    rng = random.Random(1)
    marks = [rng.random() < 0.5 for _ in range(len(features))]
    import numpy as np
    assert spread.any()
    columns = (slice(0, cotraining.CONTENT),
               slice(cotraining.CONTENT, cotraining.CONTENT + cotraining.PAGE))
    views = [cotraining.View(c, features, np.array(marks)) for c in columns]
    taken = every.slice(0, 3).select(["_row", "doc_id"])
    gone = set(taken.column("doc_id").to_pylist())
    found = cotraining.surest(table, taken, views, 4)
    for view, gift in zip(views, found):
        logits = view.logits(features)
        open_rows = {r: x for r, d, x in zip(
            every.column("_row").to_pylist(), every.column("doc_id").to_pylist(), logits)
            if d not in gone}
        best = sorted((-x, r) for r, x in open_rows.items() if x > 0)[:4]
        worst = sorted((x, r) for r, x in open_rows.items() if x < 0)[:4]
        assert set(gift.column("_row").to_pylist()) == {r for _, r in best + worst}
