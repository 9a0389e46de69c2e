"""Spelling variants: words one edit apart, by composing automata.

The vocabulary is an acceptor; composed with the transducer of exactly one edit (a symbol
inserted, deleted or replaced) and with the acceptor again it accepts the pairs sought. As
the acceptor is deterministic, both sides stand in one state until the edit, so pairs split
by the state reached before it, and a state is named by the prefix that leads to it.

- States that few words pass are partitions: a task builds the minimised acceptor of the
  words from there on, composes and enumerates all accepted pairs.
- States that many words pass, the initial one first, are opened by Spark. Pairs edited
  right there leave it by different symbols, or one by no symbol, and then agree: they
  meet by what is left of them, at most one word a symbol of the alphabet. Pairs edited
  later move on with the state's successors.

So no task sees more than ``STATE_WORDS`` words of one state, however the vocabulary is
spread. Of a run of equal symbols only the last counts as inserted, which gives each pair
one path.
"""
from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.shared import written

RUN = "[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STATE_WORDS = 2000

MISSPELL_EVERY = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5

LINK = "word string, near string, near_n long"


def small(word: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    ascii_only = F.length(word) == F.octet_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, CAPITALS, SMALL))


def misspelt(doc_id: Column, run: Column, every: int) -> Column:
    """The run without one code point where its checksum with the id says so."""
    check = F.crc32(F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (check % F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(check % every == 0, less).otherwise(run)


def vocabulary(docs: DataFrame, every: int = MISSPELL_EVERY, least_length: int = LEAST_LENGTH,
               least: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n``: how often each word of at least ``least_length`` code points occurs
    in all texts, for those that occur ``least`` times."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(
        "text", F.lit(RUN), F.lit(0))).alias("run")).filter(F.length("run") >= least_length)
    words = runs.select("doc_id", small(F.col("run")).alias("run")).select(
        (misspelt(F.col("doc_id"), F.col("run"), every) if every else F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(
        F.count("*").alias("n")).filter(F.col("n") >= least)


class Acceptor:
    """The minimal deterministic acceptor of sorted distinct words; state 0 is initial."""

    def __init__(self, words: Sequence[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        self._known: dict[tuple, int] = {}
        self._path: list[tuple[int, str, int]] = []
        before = ""
        for word in words:
            shared = 0
            while shared < min(len(word), len(before)) and word[shared] == before[shared]:
                shared += 1
            self._settle(shared)
            state = self._path[-1][2] if self._path else 0
            for symbol in word[shared:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[state][symbol] = len(self.arcs) - 1
                self._path.append((state, symbol, len(self.arcs) - 1))
                state = len(self.arcs) - 1
            self.final[state] = True
            before = word
        self._settle(0)

    def _settle(self, keep: int) -> None:
        """Merge the states at the end of the path with equal ones."""
        while len(self._path) > keep:
            state, symbol, child = self._path.pop()
            key = (self.final[child], *self.arcs[child].items())
            self.arcs[state][symbol] = self._known.setdefault(key, child)


class OneEdit:
    """The acceptor composed with the one-edit transducer and the acceptor again."""

    def __init__(self, acceptor: Acceptor):
        self.arcs, self.final = acceptor.arcs, acceptor.final
        self._common: dict[tuple[int, int], list] = {}
        self._edits: dict[int, list] = {}
        self._leads: dict[int, bool] = {}

    def common(self, one: int, two: int) -> list:
        """What both states accept, as linked symbols: the composition after the edit."""
        key = (one, two) if one <= two else (two, one)
        found = self._common.get(key)
        if found is None:
            found = [None] if self.final[one] and self.final[two] else []
            theirs = self.arcs[two]
            for symbol, next_one in self.arcs[one].items():
                if symbol in theirs:
                    found += [(symbol, rest) for rest in self.common(next_one, theirs[symbol])]
            self._common[key] = found
        return found

    def edits(self, state: int) -> list:
        """Pairs that are edited right at a state: (symbol, other symbol or none, rest)."""
        found = self._edits.get(state)
        if found is None:
            arcs = list(self.arcs[state].items())
            found = []
            for i, (symbol, after) in enumerate(arcs):
                found += [(symbol, other, rest) for other, then in arcs[:i]
                          for rest in self.common(after, then)]
                found += [(symbol, "", rest) for rest in self.common(after, state)
                          if rest is None or rest[0] != symbol]
            self._edits[state] = found
        return found

    def leads(self, state: int) -> bool:
        """Whether any pair is edited at the state or behind it."""
        if state not in self._leads:
            here = bool(self.edits(state))
            behind = [self.leads(after) for after in self.arcs[state].values()]
            self._leads[state] = here or any(behind)
        return self._leads[state]

    def pairs(self) -> Iterator[tuple[str, str]]:
        waiting = [(0, "")]
        while waiting:
            state, prefix = waiting.pop()
            if not self.leads(state):
                continue
            for symbol, other, rest in self.edits(state):
                symbols = []
                while rest is not None:
                    symbols.append(rest[0])
                    rest = rest[1]
                end = "".join(symbols)
                yield prefix + symbol + end, prefix + other + end
            waiting += [(after, prefix + symbol) for symbol, after in self.arcs[state].items()]


def one_edit_pairs(words: Sequence[str]) -> Iterator[tuple[str, str]]:
    """Each pair of distinct words one edit apart, once."""
    longest = max(map(len, words), default=0)
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * longest + 2000))
    return OneEdit(Acceptor(sorted(set(words)))).pairs()


def _enumerated(words: DataFrame) -> DataFrame:
    """Links within the partitions of ``words`` (``state``, ``word``, ``n``), both ways."""

    def links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        prefix = key[0].as_py()
        n = dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist(), strict=True))
        found = [(prefix + a, prefix + b) for a, b in one_edit_pairs([
            word[len(prefix):] for word in n])]
        found += [(b, a) for a, b in found]
        return pa.table({
            "word": pa.array([a for a, _ in found], pa.string()),
            "near": pa.array([b for _, b in found], pa.string()),
            "near_n": pa.array([n[b] for _, b in found], pa.int64())})

    return words.groupBy("state").applyInArrow(links, LINK)


def _edited_here(words: DataFrame, depth: int) -> DataFrame:
    """Links between words that are edited right after their first ``depth`` symbols."""
    rest = F.substring("word", depth + 1, 1 << 30)
    symbol = F.substring("word", depth + 1, 1)
    either = words.select("state", "word", "n", F.explode(F.array(
        F.struct(symbol.alias("symbol"), F.substring("word", depth + 2, 1 << 30).alias("rest")),
        F.struct(F.lit(None).alias("symbol"), rest.alias("rest")))).alias("cut")).filter(
        "cut.symbol is null or cut.symbol <> ''").select(
        "state", "word", "n", F.coalesce("cut.symbol", F.lit("")).alias("symbol"), "cut.rest",
        F.substring("cut.rest", 1, 1).alias("next"))
    theirs = either.select("state", "rest", F.col("word").alias("near"),
                           F.col("n").alias("near_n"), F.col("symbol").alias("other"))
    return either.join(theirs, ["state", "rest"]).filter(
        "symbol <> other and (symbol = '' or other <> '' or next <> symbol) "
        "and (other = '' or symbol <> '' or next <> other)").select("word", "near", "near_n")


def near_words(words: DataFrame, state_words: int = STATE_WORDS) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for each word (``word``, ``n``; distinct) and every
    other one that is one edit away."""
    links, depth, open_ = [], 0, words
    while True:
        placed = open_.withColumn("state", F.substring("word", 1, depth))
        # A stored table of known size, so that words are not moved by state to find it.
        crowded = written(placed.groupBy("state").agg(F.count("*").alias("words")).filter(
            F.col("words") > state_words).select("state"), f"spelling-crowded-{depth}")
        sized = written(placed.join(crowded.withColumn("crowded", F.lit(True)), "state", "left"),
                        f"spelling-states-{depth}")
        links.append(_enumerated(sized.filter("crowded is null").drop("crowded")))
        opened = sized.filter("crowded").drop("crowded")
        if opened.isEmpty():
            break
        links.append(_edited_here(opened, depth))
        open_ = opened.filter(F.length("word") > depth).select("word", "n")
        depth += 1
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found


def _roots(forms: DataFrame, hops: int) -> DataFrame:
    """``word`` and ``root`` by pointer doubling; ``hops`` bounds the length of a chain."""
    roots = forms.select("word", F.col("form").alias("root"))
    for turn in range(math.ceil(math.log2(max(hops, 1)))):
        roots = written(roots, f"spelling-roots-{turn}")
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        roots = roots.join(ahead, "root", "left").select(
            "word", F.coalesce("farther", "root").alias("root"))
    return roots


def group_variants(docs: DataFrame, every: int = MISSPELL_EVERY, least_length: int = LEAST_LENGTH,
                   least: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """For each word of the texts ``word``, ``n``, ``n_near`` (words one edit away), ``form``
    (the most frequent of those, the first in code-point order of equals, if it occurs
    ``ratio`` times as often), ``form_n`` and ``root`` (where following the forms ends).

    Words are runs of letters up to U+00FF, A-Z in lower case, some of them misspelt on
    purpose by a checksum of id and run (``every`` = 0: none). A null id counts as an empty
    one, null texts have no words, repeated rows count as often as they occur. Other columns
    are not read. A word of any length is one word. ``ratio`` has to be above 1.
    """
    if ratio <= 1:
        raise ValueError("a form has to be more frequent than its variant")
    words = written(vocabulary(docs, every, least_length, least), "spelling-words")
    near = near_words(words)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    joined = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.rank") >= ratio * F.col("n"), F.col("best")).alias("best")).select(
        "word", "n", "n_near", F.col("best.near").alias("form"),
        (-F.col("best.rank")).alias("form_n")), "spelling-forms")
    most = words.agg(F.max("n")).first()[0] or least
    # Every step multiplies the count.
    hops = math.floor(math.log(most / least) / math.log(ratio) + 1e-9)
    roots = _roots(joined.filter("form is not null"), hops)
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
