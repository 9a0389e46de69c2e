import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallystar.llm import decontamination

WORDS = [f"{a}{b}" for a in ("lor", "ip", "dol", "sit", "am", "con") for b in ("um", "et", "a", "is")]


def cut(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def bag(words, size):
    return Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(docs, items):
    out = {}
    for doc_id, text in docs:
        words = cut(text)
        for item_id, item in items:
            own = cut(item)
            if not own or not words:
                continue
            n, size = len(own), min(5, len(own))
            if len(words) < size:
                continue
            for start in range(max(1, len(words) - n + 1)):
                window = bag(words[start:start + n], size)
                theirs = bag(own, size)
                sim = sum((window & theirs).values()) / sum((window | theirs).values())
                if sim >= 0.8:
                    out[doc_id, item_id] = max(sim, out.get((doc_id, item_id), 0))
    return out


@pytest.fixture
def tables(spark, documents):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((12, 20, 35, 60, 60, 5, 3, 1))]
    items += [(20, None), (21, "..."), (22, items[2][1].upper()), (2, items[2][1])]
    docs = []
    for i in range(60):
        body = text(40).split()
        if i % 3 == 0:
            _, item = items[i % 8]
            words = item.split()
            if i % 2 and len(words) > 30:
                words[rng.randrange(len(words))] = "changed"
            if i % 4 == 0:
                words = words[2:]
            body[10:10] = words
        docs.append((i, ", ".join(body)))
    docs += [(100, items[3][1]), (101, " ".join(items[3][1].split()[:50])), (102, None), (103, ""),
             (104, text(5) + " " + items[4][1] + " " + items[4][1]), (105, "tiny"),
             (106, text(3000) + " " + items[2][1]), (0, docs[0][1])]
    return docs, items, documents(docs), spark.createDataFrame(items, "item_id long, text string")


def test_brute_force(tables):
    docs, items, docs_df, items_df = tables
    expected = brute(docs, items)
    assert len(expected) > 15 and any(v < 1 for v in expected.values())
    got = decontamination.contaminated(docs_df, items_df).collect()
    found = {(r.doc_id, r.item_id): r.similarity for r in got}
    assert len(found) == len(got) and found == pytest.approx(expected)


def test_reordered_passages(spark, documents):
    rng = random.Random(4)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    a, b, c = text(30), text(30), text(20)
    items = [(1, " ".join(a + b)), (2, " ".join(c + a + b))]
    docs = [(i, " ".join(text(cut_a) + second + first + text(cut_b)))
            for i, (cut_a, first, second, cut_b) in enumerate([
                (200, a, b, 200), (0, a, b, 90), (90, a, b, 0), (0, a, b, 0), (70, a, a, 70),
                (50, c + a, b, 50), (50, a + b, c, 50), (5, a[:28], b, 100)])]
    docs += [(None, docs[0][1]), (None, " ".join(text(80)))]
    expected = brute(docs, items)
    assert {(i, 1) for i in range(4)} <= set(expected)
    got = decontamination.contaminated(
        documents(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(expected)


def test_clean_documents_stay(tables):
    docs, items, docs_df, items_df = tables
    bad = {d for d, _ in brute(docs, items)}
    extra = docs_df.withColumns({"words": F.lit(1), "n": F.lit(2), "anchor": F.lit(3)})
    got = decontamination.without_contaminated(extra, items_df)
    assert got.columns == extra.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(d for d, _ in docs if d not in bad)


def test_empty_tables(tables, documents):
    _, _, docs_df, items_df = tables
    assert decontamination.contaminated(docs_df, items_df.limit(0)).count() == 0
    assert decontamination.contaminated(documents([]).limit(0), items_df).count() == 0


def test_blocks_find_all_within_the_radius(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        halves = [rng.getrandbits(64), rng.getrandbits(64)]
        flips = rng.sample(range(128), i % 40)
        other = [h ^ sum(1 << b % 64 for b in flips if b // 64 == k) for k, h in enumerate(halves)]
        rows.append((i, len(flips), *(h - 2**64 if h >= 2**63 else h for h in halves + other)))
    df = spark.createDataFrame(rows, "i int, flips int, a long, b long, c long, d long")

    def cut(one, two, flips):
        return df.select("i", F.col(one).alias("one"), F.col(two).alias("two")).select(
            "i", F.explode(decontamination._blocks(flips)).alias("k"))

    met = {r.i for r in cut("a", "b", 1).join(cut("c", "d", 2), ["i", "k"]).select(
        "i").distinct().collect()}
    assert {r[0] for r in rows if r[1] <= decontamination.RADIUS} <= met


def test_fingerprints_of_windows_are_those_of_their_words(spark, documents):
    """Differences of running sums give the same bits as counting a window's words."""
    rng = random.Random(8)
    words = [rng.choice(WORDS) for _ in range(90)]
    texts = spark.createDataFrame([(1, words)], "doc long, words array<string>")
    starts = spark.createDataFrame(
        [(1, 20, 5, 90, s) for s in (0, 1, 33, 70)] + [(1, 200, 5, 90, 0)],
        "doc long, n int, k int, n_words int, start int")
    items = spark.createDataFrame(
        [(i, " ".join(words[s:s + 20])) for i, s in enumerate((0, 1, 33, 70))]
        + [(9, " ".join(words))], "item_id long, text string")
    got = {(r.one, r.two) for r in decontamination._fingerprints(texts, starts).collect()}
    expected = {(r.one, r.two) for r in decontamination.benchmark_items(items).collect()}
    assert got == expected and len(got) == 5


def test_cost_grows_with_the_item_and_not_its_square(spark, documents):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    shifted = words[:1400] + [f"o{i}" for i in range(40)] + words[1440:]
    docs = documents([(1, " ".join(["x"] * 50 + words)), (2, " ".join(shifted)), (3, "x y z")])
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.contaminated(docs, items).collect()}
    assert set(got) == {1, 2}
    assert got[1].similarity == 1 and got[1].first_word == 0 and got[1].windows == 51
    assert got[2].similarity == pytest.approx((2996 - 44) / (2996 + 44))


@pytest.mark.parametrize("names", [
    ("row", "mark", "doc", "words", "at", "key_0", "of_0"), ("item", "n", "k", "_bad", "_id", "b")])
def test_clashing_names(tables, names):
    docs, items, docs_df, items_df = tables
    extra = docs_df.withColumns({name: F.lit(name) for name in names})
    bad = {d for d, _ in brute(docs, items)}
    got = decontamination.without_contaminated(
        extra, items_df.withColumns({name: F.lit(name) for name in names}))
    assert got.columns == extra.columns
    assert sorted((r.doc_id, *(r[n] for n in names)) for r in got.collect()) == sorted(
        (d, *names) for d, _ in docs if d not in bad)
