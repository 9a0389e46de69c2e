import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.llm import recompression
from tallystar.llm.recompression import name_pairs, name_runs, word_symbols

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    cut = [WORD.findall(text or "") for _, text in rows]
    seen = Counter(tuple(w[i:i + size]) for w in cut for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), words in zip(rows, cut):
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if seen[tuple(words[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        out.append((doc_id, len(words), sum(gone),
                    " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=str)


def passages():
    rng = random.Random(11)
    vocabulary = [f"w{i}é" for i in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared, again = text(50), text(35)
    rows = [(i, f"{text(30)}\n{shared if i % 2 else again}\t{text(20)}") for i in range(30)]
    rows += [(i, rows[i - 30][1][:-9] + "changed") for i in range(30, 50)]
    rows += [(90, None), (91, ""), (92, " \n"), (93, "a " * 80), (94, "a " * 60),
             (95, "a b " * 50), (96, again), (None, shared), (None, None), (3, rows[3][1]),
             (97, "x " * 34), (98, "x " * 34), (99, text(4000) + " " + shared + " end"),
             (99, "z " + shared), (100, "UPPER " + shared.upper())]
    return rows


@pytest.mark.parametrize("rounds,chunk", [(4, 4000), (1, 1 << 20), (7, 4000)])
def test_brute_force(documents, monkeypatch, rounds, chunk):
    monkeypatch.setattr(recompression, "CHUNK_BYTES", chunk)
    rows = passages()
    got = recompression.remove_repeats(documents(rows).repartition(3), rounds=rounds).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 35)


def test_other_window_empty_table_and_extra_columns(documents):
    rows = [(i % 3, f"one two three {i // 2} four five six") for i in range(12)]
    docs = documents(rows)
    for name in ("chunk", "task", "words", "part", "codes", "kept", "names", "ids"):
        docs = docs.withColumn(name, F.lit(name))
    got = recompression.remove_repeats(docs, size=4).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 4)
    assert recompression.remove_repeats(documents([]).limit(0)).count() == 0


def test_equal_stretches_get_equal_symbols_within_their_context():
    rng = np.random.RandomState(5)
    words = rng.randint(1, 6, 400).astype(np.uint64)
    copy = np.concatenate([rng.randint(1, 6, 90).astype(np.uint64), words[100:220],
                           rng.randint(1, 6, 60).astype(np.uint64)])
    one, two = (word_symbols(w, np.array([len(w)])) for w in (words, copy))
    for number in range(5):
        one, two = (name_pairs(name_runs(s), number, number % 4) for s in (one, two))
        found = {(n, a + 10, b + 10, c + 10) for n, a, b, c in zip(
            two.name, two.start, two.low, two.high)}
        inside = (one.low >= 100) & (one.high <= 220)
        assert inside.any()
        for n, a, b, c in zip(one.name[inside], one.start[inside] - 10 + 10, one.low[inside],
                              one.high[inside]):
            assert (n, a, b, c) in found


def test_windows_of_one_anchor_that_differ_by_one_hash_half_are_apart(spark):
    """Two keys that agree in their first 64 bits only are two keys."""
    keys = np.array([7, 7, 7], np.uint64)
    values = np.array([2, 4, 4], np.uint64)
    distinct, only, _, number = recompression._entries(keys, values, 1, pairs=True)
    assert len(distinct) == 2 and sorted(only & np.uint64(1)) == [0, 1]
    assert number[1] == number[2] != number[0]
    _, only, _, _ = recompression._entries(keys, values, 1)
    assert len(only) == 1 and only[0] == 1
