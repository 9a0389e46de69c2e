import hashlib
import random

import numpy as np
import pytest

from tallystar.llm import suffix_array


def brute(rows):
    seen, out = {}, []
    for doc_id, text in rows:
        data = (text or "").encode()
        key = suffix_array.NO_ID if doc_id is None else doc_id
        for i in range(len(data) - 49):
            w = data[i:i + 50]
            seen[w] = min(seen.get(w, key), key)
    for doc_id, text in rows:
        data = (text or "").encode()
        key = suffix_array.NO_ID if doc_id is None else doc_id
        mark = bytearray(len(data))
        for i in range(len(data) - 49):
            if seen[data[i:i + 50]] < key:
                mark[i:i + 50] = b"\1" * 50
        spans = sum(m and not (i and mark[i - 1]) for i, m in enumerate(mark))
        kept = bytes(b for b, m in zip(data, mark) if not m)
        out.append((doc_id, len(data), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages():
    rng = random.Random(3)
    words = ["alpha", "béta", "gamma", "delta", "ε", "zeta", "eta", "theta", "a", "of"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 30)) for _ in range(n))
    shared, again = text(25), text(12)
    rows = [(i, f"{text(20)} {shared if i % 2 else again} {text(15)}") for i in range(40)]
    rows += [(i, rows[i - 40][1][:-7] + "x") for i in range(40, 60)]
    rows += [(100, None), (101, ""), (102, "short"), (103, "ab" * 400), (104, "ab" * 300),
             (105, "x" * 50), (3, "x" * 50), (106, "x" * 49), (None, shared), (None, again * 2),
             (5, rows[5][1]), (5, shared), (200, text(6000) + shared), (107, rows[30][1])]
    return rows


@pytest.mark.parametrize("hot", [4096, 3])
def test_brute_force(documents, monkeypatch, hot):
    monkeypatch.setattr(suffix_array, "CHUNK_BYTES", 20000)
    monkeypatch.setattr(suffix_array, "HOT_DOCUMENTS", hot)
    monkeypatch.setattr(suffix_array, "BATCH_READS", 7)
    rows = passages()
    got = suffix_array.remove_repeats(documents(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_remaining_bytes_and_empty_table(documents):
    rows = [(1, "p" * 60), (2, "a" + "p" * 55 + "b")]
    got = {r.doc_id: bytes(r.kept) for r in
           suffix_array.remove_repeats(documents(rows), texts=True).collect()}
    assert got == {1: b"p" * 60, 2: b"ab"}
    assert suffix_array.remove_repeats(documents([]).limit(0)).count() == 0


def test_index_sorts_suffixes(tmp_path):
    rng = np.random.RandomState(0)
    reads = [bytes(rng.choice(list(b"ab"), rng.randint(1, 40)).astype(np.uint8)) for _ in range(60)]
    data = np.frombuffer(b"".join(reads), np.uint8)
    lengths = np.array([len(r) for r in reads])
    index = suffix_array.ColumnIndex(data, np.cumsum(lengths) - lengths, lengths, str(tmp_path))
    rows = {int(r): b"" for r in range(60)}
    for size, at in enumerate(index.suffixes(40), 1):
        rows.update({int(at[i]): reads[i][-size:] for i in range(60) if len(reads[i]) >= size})
    texts = [rows[r] for r in range(len(rows))]
    assert texts == sorted(texts) and len(texts) == 60 + lengths.sum()
    common = [0] + [next((k for k in range(min(len(a), len(b))) if a[k] != b[k]),
                         min(len(a), len(b))) for a, b in zip(texts, texts[1:])]
    assert list(index._columns()[1]) == common
