import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallystar.llm import spelling

LOWER = str.maketrans(spelling.CAPITALS, spelling.SMALL)


def near_of(words):
    near, rest = defaultdict(set), defaultdict(list)
    for word in words:
        for i in range(len(word)):
            less = word[:i] + word[i + 1:]
            rest[i, less].append(word)
            if less in words:
                near[word].add(less)
                near[less].add(word)
    for group in rest.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    return near


def brute(rows, every=199, least_length=6, least=5, ratio=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            check = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and check % every == 0:
                run = run[:check % len(run)] + run[check % len(run) + 1:]
            if len(run) >= least_length:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= least}
    near, forms = near_of(words), {}
    for word, n in words.items():
        if near[word]:
            best = min(near[word], key=lambda x: (-words[x], x))
            if words[best] >= ratio * n:
                forms[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in forms:
            root = forms[root]
        out.append((word, forms.get(word), root, n, len(near[word]), words.get(forms.get(word))))
    return sorted(out)


def corpus():
    rng = random.Random(13)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 8))) for _ in range(60)]
    stems += ["letter", "lettter", "lettr", "Letter", "ÀLETTER", "àletter", "aaaaaa", "aaaaaaa",
              "aaaaaaaa", "étoile÷s", "dont't", "short"]
    weights = [5 ** rng.randint(0, 4) for _ in stems]
    rows = [(i, " ".join(rng.choices(stems, weights, k=120))) for i in range(60)]
    return rows + [(None, "letter " * 9), (None, None), (7, ""), (7, rows[7][1]), (8, "1 2 3"),
                   (9, "y" * 9000 + " " + "y" * 8999 + " end"), (10, ("q" * 3000 + " ") * 6)]


@pytest.mark.parametrize("every, state_words", [(3, 2000), (0, 3), (3, 1)])
def test_brute_force(documents, monkeypatch, every, state_words):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (state_words,))
    rows = corpus()
    docs = documents(rows).withColumns({n: F.lit(n) for n in ("word", "n", "state", "near", "run")})
    if state_words < 2000:  # a state is opened symbol by symbol, so without the longest
        rows = rows[:-2]
        docs = docs.filter("length(text) < 9000")
    got = spelling.group_variants(docs, every=every).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, every)


def test_empty_table_and_ratio(documents):
    assert spelling.group_variants(documents([]).limit(0)).count() == 0
    assert spelling.group_variants(documents([(1, None), (2, "")])).count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(documents([(1, "a")]), ratio=1)


def test_pairs_of_the_composition_come_once():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 7)))
                    for _ in range(150)})
    found = [tuple(sorted(p)) for p in spelling.one_edit_pairs(words)]
    expected = {tuple(sorted((a, b))) for a, others in near_of(set(words)).items() for b in others}
    assert len(found) == len(set(found)) and set(found) == expected
    assert list(spelling.one_edit_pairs([])) == []


def test_the_acceptor_is_minimal():
    acceptor = spelling.Acceptor(["car", "cars", "far", "fars"])
    used = {0} | {child for arcs in acceptor.arcs for child in arcs.values()}
    accepted, waiting = [], [(0, "")]
    while waiting:
        state, word = waiting.pop()
        if acceptor.final[state]:
            accepted.append(word)
        waiting += [(s, word + c) for c, s in acceptor.arcs[state].items()]
    assert sorted(accepted) == ["car", "cars", "far", "fars"]
    reached = {0}
    for _ in used:
        reached |= {s for r in reached for s in acceptor.arcs[r].values()}
    assert len(reached) == 5


def test_chains_of_forms(documents):
    text = " ".join(["colours"] * 5 + ["colour"] * 25 + ["colourx"] * 5 + ["colouur"] * 125)
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.group_variants(
        documents([(1, text)]), every=0).collect()}
    assert got == {"colours": ("colour", "colouur", 2), "colourx": ("colour", "colouur", 2),
                   "colour": ("colouur", "colouur", 3), "colouur": (None, "colouur", 1)}
