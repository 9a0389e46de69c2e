import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Share by weight, again and again, until no target is over its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in capped]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            return {**capped, **{s: left * weight[s] / total for s in open_}}
        for s in over:
            capped[s] = most * sizes[s]
        left = share * sum(sizes.values()) - sum(capped.values())


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 500, "c": 30, "d": 0, None: 60},
    {"é": 7, "z": 7, "Z": 7}, {"only": 9},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_pairs_keep_words_and_chances():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 50, 200).astype(float)
    totals = np.zeros(200)
    for _ in range(300):
        parts = np.full(200, 0.37)
        held = mixing.round_pairs(parts, sizes, np.arange(200), rng.random(200))
        assert abs((parts * sizes).sum() - 0.37 * sizes.sum()) < 1e-6
        assert sum(0 < p < 1 for p in parts) <= 1 and (held < 0 or 0 < parts[held] < 1)
        totals += parts
    assert abs(totals.mean() / 300 - 0.37) < 0.01 and totals.std() / 300 < 0.06


def mixed(docs):
    return mixing.mix(docs, mixing.word_count(F.col("text")))


def test_mix(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "abc"[i % 3] if i % 5 else "a") for i in range(300)]
    rows += [(7, None, "a"), (8, "", "b"), (9, " \t", None), (10, "x " * 30, None)]
    rows += [(11, "same text", "c")] * 3
    docs = documents(rows)
    got = mixed(docs).collect()
    assert len(got) == len(rows)
    sums = {}
    for r in got:
        assert 0 <= r.copies <= 2
        s = sums.setdefault(r.source, [0, 0, r.target])
        s[0] += r.size
        s[1] += r.size * r.copies
    for total, taken, target in sums.values():
        assert abs(taken - target) <= 60 and total * 2 >= target
    assert {s: v[2] for s, v in sums.items()} == pytest.approx(
        brute_targets({s: v[0] for s, v in sums.items()}))
    assert sorted(map(str, got)) == sorted(map(str, mixed(docs.repartition(3)).collect()))


def test_empty_and_clashing_columns(documents):
    assert mixed(documents([]).limit(0)).count() == 0
    clash = documents([(1, "a b"), (2, "c")]).withColumns(
        {"copies": F.lit(9), "target": F.lit("x"), "extra": F.lit(1)})
    got = mixed(clash)
    assert got.columns.count("copies") == 1 and "extra" in got.columns
    assert got.agg(F.max("copies")).first()[0] <= 2
