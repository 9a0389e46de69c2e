import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tallystar.llm import pii

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
               for i, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": lambda: True,
                    "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                    "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


HARD = [
    "a@b.c_d@e.f x1.2.3.4.5.6.7.8 1..2 256.1.1.1 0001.02.3.004",
    "+1 (386) 555-3733 +12 +123456789 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "4111 1111 1111 1111-4111-1111-1111-1111 4111111111111111 é4111111111111111😀 a@b.co",
    "a" * 3000 + "@" + "b.c" * 50, "@@a@b..c@d.e.f--", "", None, "1" * 1000 + ".1.1.1",
    "x@y.z,q@r.s+1@t.u", "a@b" + ".c" * 30000 + " " + "1 " * 30000 + "+1" + "(" * 30000,
    "no data here", "ß+49 30 1234567 8.8.8.8", "12-34 5678-9012 3452",
]


def test_patterns(documents):
    rows = documents(list(enumerate(HARD))).withColumn("s", pii.base_spans())
    for row in rows.collect():
        assert [(s.start, s.rank, s.kind, s.end) for s in row.s] == brute(row.text), row.doc_id


def reveal():
    rows = [(i, f"common words of line {i} and more zanzibar near a.b{0}@mail.example.org the "
                f"common end") for i in range(4)]
    rows += [(i, "common words and the end of line with nothing else") for i in range(10, 40)]
    rows += [(50, "only zanzibär here"), (51, None), (52, ""), (0, rows[0][1])]
    return rows


def test_terms_that_reveal(documents):
    found = {r.doc_id: r.spans for r in pii.find_personal_data(documents(reveal())).collect()}
    for i in range(4):
        text = reveal()[i][1]
        terms = {text[s.start:s.end]: s.action for s in found[i] if s.kind == pii.TERM}
        assert terms["zanzibar"] == "remove" and "common" not in terms and "the" not in terms
        assert not any(s.start < t.end and t.start < s.end for s in found[i] for t in found[i]
                       if (s.start, s.kind) < (t.start, t.kind))
    assert found[10] == found[51] == found[52] == []


def test_terms_far_from_the_entity(documents):
    far = " common words" * 40
    rows = [(i, f"write to x@y.zz{far} codename") for i in range(5)]
    rows += [(10 + i, f"mail to p@q.rr {'' if i < 3 else far} mixed") for i in range(10)]
    rows += [(30 + i, f"the{far} {'often' if i < 30 else ''}") for i in range(60)]
    rows += [(100 + i, f"write to x@y.zz{far} often codename") for i in range(2)]
    found = {r.doc_id: r for r in pii.find_personal_data(documents(rows)).collect()}
    texts = dict(rows)
    for i, r in found.items():
        terms = {texts[i][s.start:s.end]: s.action for s in r.spans if s.kind == pii.TERM}
        assert terms.get("codename") == ("remove" if "codename" in texts[i] else None)
        assert terms.get("mixed") == ("remove" if "mixed" in texts[i] else None)
        assert "often" not in terms and "common" not in terms


def test_repeated_rows_change_no_span(documents):
    rows = [(i, f"write to x@y.zz about zanzibar {i}") for i in range(5)]
    rows += [(10 + i, f"the common words of text {i}") for i in range(40)]
    once = {r.doc_id: r.spans for r in pii.find_personal_data(documents(rows)).collect()}
    assert any(s.kind == pii.TERM for s in once[0])
    for copies in ([rows[0]] * 30, [rows[20]] * 400):
        got = pii.find_personal_data(documents(rows + copies)).collect()
        assert len(got) == len(rows) + len(copies)
        assert all(r.spans == once[r.doc_id] for r in got)


def test_terms_against_counting(documents):
    """Shares worked out pair by pair give the same terms."""
    rng = random.Random(12)
    mails = [f"m{i}@x.yy" for i in range(6)]
    words = [f"word{i}" for i in range(14)]
    rows = []
    for i in range(90):
        held = rng.sample(range(6), rng.choice([0, 0, 0, 1, 2]))
        own = {w for m in held for w in words[2 * m:2 * m + 2] if rng.random() < 0.9}
        own |= set(rng.sample(words, rng.choice([0, 1, 3])))
        rows.append((i, " ".join([*(mails[m] for m in held), *sorted(own)])))
    docs = [(i, {m for m in mails if m in t}, set(re.findall("[a-z0-9]+", t))) for i, t in rows]
    expected = {}
    for mail in mails:
        n_entity = sum(mail in m for _, m, _ in docs)
        for term in {w for _, _, ws in docs for w in ws}:
            n_term = sum(term in ws for _, _, ws in docs)
            both = sum(mail in m and term in ws for _, m, ws in docs)
            if both < 3 or n_entity < 3:
                continue
            share = math.log2(both * 90 / (n_entity * n_term)) / math.log2(90 / n_entity)
            if share >= pii.GENERALISE:
                for i, m, ws in docs:
                    if mail in m and term in ws:
                        expected[i, term] = max(share, expected.get((i, term), 0))
    table = documents(rows).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    found = table.withColumn("spans", pii.base_spans()).filter("size(spans) > 0")
    got = {(r.doc_id, r.term): r.share for r in pii.disclosing_terms(table, found).collect()}
    assert len(expected) > 30 and got == pytest.approx(expected)


def test_entities_and_words_of_one_document_are_not_paired(documents):
    """Groups of those found in the same documents are counted, not each with each."""
    text = " ".join(f"a{i}@x.yy w{i}" for i in range(900))
    rows = [(i, f"{text} {i}") for i in range(3)] + [(10 + i, f"text {i}") for i in range(40)]
    found = {r.doc_id: r.spans for r in pii.find_personal_data(documents(rows)).collect()}
    assert sum(s.kind == pii.TERM for s in found[0]) >= 900 and not found[10]


@pytest.mark.parametrize("names", [("_mark", "_id", "_own"), ("row", "own", "of", "clean", "spans"),
                                   ("mark", "terms", "doc", "term", "_text", "key_0")])
def test_clashing_names(documents, names):
    docs = documents(reveal()).withColumns({name: F.lit(name) for name in names})
    got = pii.sanitise(docs)
    plain = {r.doc_id: r.text for r in pii.sanitise(documents(reveal())).collect()}
    assert got.columns == docs.columns
    for r in got.collect():
        assert [r[n] for n in names] == list(names) and r.text == plain[r.doc_id]


def test_rare_pairs_reveal_nothing(documents):
    rows = [(1, "qwxyz a@b.cd"), (2, "qwxyz a@b.cd"), (3, "nothing")]
    assert all(s.kind == "email" for r in pii.find_personal_data(documents(rows)).collect()
               for s in r.spans)


def test_sanitised_documents(documents):
    docs = documents(reveal() + [(None, "mail x@y.zz!"), (60, "7" * 40)]).withColumn(
        "spans", F.lit("own"))
    got = pii.sanitise(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    texts = {r.doc_id: r for r in got.collect()}
    assert texts[None].text == "mail [EMAIL]!" and texts[None].n_chars == 13
    assert "zanzibar" not in texts[0].text and "[EMAIL]" in texts[0].text
    assert texts[0].n_chars == len(texts[0].text) and texts[51].text is None
    assert texts[60].text == "7" * 40 and texts[50].text == "only zanzibär here"


def test_empty_table(documents):
    assert pii.find_personal_data(documents([]).limit(0)).count() == 0


@pytest.mark.parametrize("spans, expected", [
    ([(0, 0, "email", 3), (1, 1, "ip", 5)], "[EMAIL]fg"), ([], "abcdefg"),
    ([(2, 2, "card", 7)], "ab[CARD]"),
])
def test_overlaps(spark, spans, expected):
    df = spark.createDataFrame(
        [("abcdefg", [(*s, "v", "remove") for s in spans])], f"text string, s array<{pii.SPAN}>")
    assert df.select(pii.sanitised("text", "s")).first()[0] == expected
