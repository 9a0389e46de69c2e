import hashlib

import pytest
from pyspark.sql import functions as F

from tallystar.llm import merkle

TEXTS = [
    (5, "One. Two. Three.\nFour. Five.\n\nSix. Seven. Eight. Nine. Ten."), (4, "é😀" * 50), (3, ""),
    (2, None), (9, "single"), (7, "\n\n\n"), (8, "a.b.c.\n" * 200), (1, "x" * 1000),
    (6, "One. Two. Three.\nFour. Five.\n\nSix. Seven. Eight. Nine. Ten."),
]


@pytest.mark.parametrize("bucket", [16 << 20, 100])
def test_next_and_edited(documents, monkeypatch, bucket):
    monkeypatch.setattr(merkle, "BUCKET_BYTES", bucket)
    rows = merkle.with_next(documents(TEXTS)).withColumn(
        "edited", merkle.edited(F.col("text"), F.col("next_text"))).collect()
    down = sorted(((d, t or "") for d, t in TEXTS), reverse=True)
    following = {d: down[(i + 1) % len(down)][1] for i, (d, _) in enumerate(down)}
    assert {r.doc_id: r.next_text for r in rows} == following
    for r in rows:
        third = len(r.text) // 3
        assert r.edited == r.text[:len(r.text) - third] + r.next_text[:third]


def test_repeated_and_missing_ids(documents, monkeypatch):
    monkeypatch.setattr(merkle, "BUCKET_BYTES", 8)
    rows = [(1, "aaaa"), (1, "bbbb"), (1, "aaaa"), (None, "cccc"), (None, "dddd"), (2, "eeee")]
    got = merkle.with_next(documents(rows)).collect()
    assert sorted(r.next_text for r in got) == sorted(t for _, t in rows)
    assert [r for r in got if r.doc_id == 2][0].next_text in ("aaaa", "bbbb")
    assert merkle.with_next(documents([]).limit(0)).count() == 0


def trees(documents, *texts):
    rows = merkle.fingerprints(documents(list(enumerate(texts)))).orderBy("doc_id")
    return rows.collect()


def test_equal_roots_are_equal_texts(documents):
    found = merkle.fingerprints(documents(TEXTS)).collect()
    by_text = {}
    for r in found:
        by_text.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({f for v in by_text.values() for f in v}) == len(by_text)


def test_tree_holds_every_character(documents):
    text = "One. Two.\n" * 9 + "\nLast é " + "y" * 200
    tree, = trees(documents, text)
    pieces, rest = [], text
    leaves = [leaf for s in tree.sections for p in s.paragraphs for leaf in p.leaves]
    for leaf in leaves:
        size = next(n for n in range(1, len(rest) + 1)
                    if hashlib.md5(rest[:n].encode()).hexdigest()[:merkle.LEAF_HEX] == leaf)
        pieces.append(rest[:size])
        rest = rest[size:]
    assert "".join(pieces) == text and not rest
    assert [len(s.paragraphs) for s in tree.sections] == [8, 2, 1]


def test_differing_branches_and_likeness(spark, documents):
    lines = [f"line {i}." for i in range(20)]
    changed = list(lines)
    changed[12] = "other."
    df = documents([(0, "\n".join(lines))]).withColumn("b", F.lit("\n".join(changed)))
    df = df.select(merkle.merkle_tree(F.col("text")).alias("x"), merkle.merkle_tree(F.col("b")).alias("y"))
    row = df.select(
        merkle.differing_branches(F.col("x"), F.col("y")).alias("d"),
        merkle.likeness(merkle.leaves(F.col("x")), merkle.leaves(F.col("y"))).alias("l"),
        merkle.likeness(merkle.leaves(F.col("x")), merkle.leaves(F.col("x"))).alias("same")).first()
    assert [(b.section, list(b.paragraphs)) for b in row.d] == [(1, [4])]
    assert row.l == pytest.approx(19 / 20) and row.same == 1.0
