import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.llm import hyperminhash
from tallystar.llm.blocks import blocks


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted((rows[i][0], len(sets[i]), least[top(i)]) for i in range(len(rows)))


def corpus():
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefgh") + str(rng.randint(0, 40))
    rows, doc_id = [], 0
    for length in (1, 3, 4, 5, 9, 24, 60, 300):
        for _ in range(3):
            base = [word() for _ in range(length)]
            for k in range(9):
                text = list(base)
                for _ in range(k // 2):
                    text[rng.randrange(length)] = word()
                if k == 7:
                    text = text[:-1] or text
                rows.append((doc_id, ("  " if k % 2 else "\n").join(text).upper() if k == 3
                             else " ".join(text)))
                doc_id += 1
    chain = [word() for _ in range(200)]
    for k in range(12):  # each near the next, the ends far apart
        rows.append((doc_id, " ".join(chain[10 * k:10 * k + 100])))
        doc_id += 1
    rng.shuffle(rows)
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "x " * 5000), (904, "x x x x x")]


@pytest.mark.parametrize("size, block", [(4, 1024), (5, 3)])
def test_brute_force(documents, monkeypatch, size, block):
    monkeypatch.setattr(hyperminhash, "BLOCK_MEMBERS", block)
    rows = corpus()
    got = hyperminhash.near_duplicates(documents(rows), size=size).collect()
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)
    assert found == brute(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_of_each(documents):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text), (1, text), (1, text), (2, text + " z"), (None, text), (7, None), (8, ""),
            (7, None), (None, "alone in the whole corpus now"), (9, "another one that is alone")]
    docs = documents(rows).withColumn("kept", F.lit("own"))
    got = hyperminhash.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in got.collect()) == sorted([
        ("1", text), ("7", ""), ("7", ""), ("8", ""), ("None", "alone in the whole corpus now"),
        ("9", "another one that is alone")])
    assert hyperminhash.one_of_each(documents([]).limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [
        (rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(200, 500)]
    edges = [(min(e), max(e)) for e in edges if e[0] != e[1]]
    group = {n: n for e in edges for n in e}
    for _ in group:
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    got = hyperminhash.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == group


def test_registers_estimate_similarity(documents):
    import pyarrow as pa

    common = [f"c{i}" for i in range(4000)]
    texts = [" ".join(f"{x} a b c d" for x in common[k * 400:2000 + k * 400]) for k in range(5)]
    block, = blocks(pa.array(texts), 1 << 30)
    found, bounds = hyperminhash.distinct_shingles(block, 5)
    rows = hyperminhash.fine_registers(found, bounds)
    sizes = np.diff(bounds).astype(float)
    for k in range(1, 5):
        real = len(shingles(texts[0], 5) & shingles(texts[k], 5)) / len(
            shingles(texts[0], 5) | shingles(texts[k], 5))
        guess, = hyperminhash.estimate(rows[:1], rows[k:k + 1], sizes[0], sizes[k:k + 1])
        assert abs(guess - real) < 0.05
