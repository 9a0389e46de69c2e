"""Licence scan with a positional index of rare words.

Document frequencies over the whole corpus say how rare each word of the licence
templates is. The index lists, for the rarest words of each template, where they stand
in it. A file looks up its words in that index; postings that agree on where the template
would begin are one place, which counts if enough of the template's weight (the sum of
its words' inverse document frequencies) stands in position there and every mandatory key
phrase of the template is in that stretch.
"""
from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.blocks import ALPHANUMERIC, LOWER, Block, blocks, column_of, word_hashes

# Phrases that always count, with their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


class Template(NamedTuple):
    label: str
    text: str
    key_phrases: tuple[str, ...]


# Opening words of common licence notices.
TEMPLATES = (
    Template("gpl", "this work is licensed under the gnu general public license version 3",
             ("gnu general public license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under "
             "the terms of the gnu general public license as published by the free software "
             "foundation", ("gnu general public license", "free software foundation")),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the "
             "free software foundation", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license as published by the "
             "free software foundation", ("gnu affero general public license",)),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use "
             "this file except in compliance with the license",
             ("apache license", "in compliance with the license")),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
             "this software and associated documentation files",
             ("permission is hereby granted", "associated documentation files")),
    Template("bsd", "redistribution and use in source and binary forms with or without "
             "modification are permitted provided that the following conditions are met",
             ("source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose "
             "with or without fee is hereby granted", ("with or without fee",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v "
             "2 0", ("mozilla public license",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("public domain dedication",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("unencumbered software",)),
)
LEAST_WEIGHT = 0.6
SLACK = 3

PLACES = "array<struct<label:string,start:bigint>>"
MATCHES = "array<struct<label:string,start:bigint,score:double>>"


def _cut(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def _hashed(words: Sequence[str]) -> np.ndarray:
    joined = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = Block(0, np.array([0, len(joined)]), joined).words(ALPHANUMERIC)
    return word_hashes(joined, starts, ends)


def _words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[block.data]
    starts, ends, bounds = block.words(ALPHANUMERIC)
    return word_hashes(data, starts, ends), bounds


def _among(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Index into sorted ``known``, or -1."""
    if not len(known):
        return np.full(len(words), -1)
    place = np.searchsorted(known, words)
    place[place == len(known)] = 0
    place[known[place] != words] = -1
    return place


def document_frequencies(docs: DataFrame, templates: Sequence[Template] = TEMPLATES):
    """Documents with each template word, by hash, and documents in all."""
    known = np.unique(_hashed(sorted({w for t in templates for w in _cut(t.text)})))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(len(known), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for block in blocks(column_of(batch, "text")):
                words, bounds = _words(block)
                place = _among(words, known)
                at = np.flatnonzero(place >= 0)
                owner = np.searchsorted(bounds, at, "right") - 1
                pairs = np.unique(owner * len(known) + place[at])
                found += np.bincount(pairs % len(known), minlength=len(known))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(known.view(np.int64), 0)), pa.array(np.append(found, rows)),
             pa.array([False] * len(known) + [True])], ["word", "n", "whole"])

    sums = docs.select("text").mapInArrow(count, "word long, n long, whole boolean").groupBy(
        "word", "whole").agg(F.sum("n").alias("n")).collect()  # a row per template word
    return ({row.word: row.n for row in sums if not row.whole},
            next((row.n for row in sums if row.whole), 0))


class Index:
    """Rare words of the templates with their positions, and what verification needs."""

    def __init__(self, templates: Sequence[Template], frequencies: dict[int, int], rows: int):
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.templates = []
        for number, template in enumerate(templates):
            words = _hashed(_cut(template.text))
            weights = np.array([
                math.log((1 + rows) / (1 + frequencies.get(int(w), 0))) + 1e-3
                for w in words.view(np.int64)])
            weights /= weights.sum()
            present = [i for i, w in enumerate(words.view(np.int64)) if frequencies.get(int(w), 0)]
            rest = float(weights[present].sum())
            for i in sorted(present, key=lambda i: (-weights[i], i)):
                if rest < LEAST_WEIGHT - 1e-9:
                    break
                self.postings[int(words[i])].append((number, i))
                rest -= float(weights[i])
            keys = [_hashed(_cut(phrase)) for phrase in template.key_phrases]
            self.templates.append((template.label, words, weights, keys))
        self.known = np.array(sorted(self.postings), np.uint64)

    def places(self, words: np.ndarray, hits: np.ndarray) -> list[dict]:
        """Verified places in one document, given where its indexed words stand."""
        votes = Counter(
            (number, int(at) - place)
            for at in hits for number, place in self.postings[int(words[at])])
        found = {}
        for (number, start), _ in sorted(votes.items()):
            label, text, weights, keys = self.templates[number]
            low, high = max(start, 0), min(start + len(text), len(words))
            same = words[low:high] == text[low - start:high - start]
            score = float(weights[low - start:high - start][same].sum())
            if score < LEAST_WEIGHT:
                continue
            stretch = words[max(low - SLACK, 0):high + SLACK]
            if all(len(phrase_starts(stretch, key)) for key in keys):
                at = max(start, 0)
                found[label, at] = max(score, found.get((label, at), 0.0))
        return [{"label": label, "start": at, "score": min(score, 1.0)}
                for (label, at), score in sorted(found.items(), key=lambda x: (x[0][1], x[0][0]))]


def phrase_starts(words: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    if len(words) < len(phrase):
        return np.zeros(0, np.int64)
    runs = len(words) - len(phrase) + 1
    at = np.flatnonzero(words[:runs] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[words[at + k] == phrase[k]]
    return at


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES,
                  base: Sequence[tuple[str, str]] = BASE_PHRASES) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``base`` (places of the base
    phrases) and ``matches`` (verified places of templates with their scores, by start).

    Starts count words from 0. A null text is empty and has no places; repeated rows each
    give their own row; without rows there are none. Only ``doc_id`` and ``text`` are read.
    Templates whose words all are frequent still work, as only ranks decide what is rare.
    """
    frequencies, rows = document_frequencies(docs, templates)
    index = Index(templates, frequencies, rows)
    phrases = [(label, _hashed(_cut(text))) for text, label in base]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            base_places: list[list] = [[] for _ in range(batch.num_rows)]
            matches: list[list] = [[] for _ in range(batch.num_rows)]
            for block in blocks(column_of(batch, "text")):
                words, bounds = _words(block)
                counts[block.first:block.first + len(block)] = np.diff(bounds)
                for label, phrase in phrases:
                    at = phrase_starts(words, phrase)
                    owner = np.searchsorted(bounds, at, "right") - 1
                    inside = at + len(phrase) <= bounds[owner + 1]
                    for i, j in zip(owner[inside].tolist(), at[inside].tolist(), strict=True):
                        base_places[block.first + i].append(
                            {"label": label, "start": j - int(bounds[i])})
                hits = np.flatnonzero(_among(words, index.known) >= 0)
                owner = np.searchsorted(bounds, hits, "right") - 1
                for i in np.unique(owner).tolist():
                    own = hits[owner == i] - bounds[i]
                    matches[block.first + i] = index.places(words[bounds[i]:bounds[i + 1]], own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts),
                 pa.array(base_places, pa.list_(pa.struct(
                     [("label", pa.string()), ("start", pa.int64())]))),
                 pa.array(matches, pa.list_(pa.struct(
                     [("label", pa.string()), ("start", pa.int64()), ("score", pa.float64())])))],
                ["doc_id", "n_words", "base", "matches"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, n_words long, base {PLACES}, matches {MATCHES}")
