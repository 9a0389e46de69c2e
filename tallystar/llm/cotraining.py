"""Quality classifier by co-training two views of a document.

The content view describes the letters and words of a text; the metadata view describes
the page around it: source, language, stated length and the layout of lines. Each view
has a logistic classifier. In every round each classifier marks the documents without
label that it is surest of, and the other view learns from them. Afterwards each view is
calibrated on labelled documents that it did not learn from, and the calibrated views,
weighted by how well they did there, are combined into one score for every document.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.blocks import LOWER, VISIBLE, Block, blocks, column_of, word_hashes
from tallystar.llm.shared import packed, written

LABELLED = 20000
ROUNDS = 3
PER_ROUND = 500
HASHED = 8
THRESHOLD = 0.5

_CODES = np.arange(256)
_CLASSES = np.array([
    (65 <= _CODES) & (_CODES <= 90), (97 <= _CODES) & (_CODES <= 122),
    (48 <= _CODES) & (_CODES <= 57), _CODES >= 128, np.isin(_CODES, list(b".,;:?'\"()-")),
    _CODES == ord("!"), np.isin(_CODES, list(b"|<>{}[]=/\\_")), np.isin(_CODES, list(b"#$%&*@~^+")),
])
CONTENT = len(_CLASSES) + 8
PAGE = 7 + 2 * HASHED


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _concentration(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each document over all of them, and the chance that two agree."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    if not len(keys):
        return np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1)
    heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])))
    runs = np.diff(np.append(heads, len(keys))).astype(float)
    n = np.maximum(np.diff(bounds), 1)
    distinct = np.bincount(owner[heads], minlength=len(n)) / n
    return distinct, np.bincount(owner[heads], runs * runs, len(n)) / (n.astype(float) * n)


def content_features(block: Block) -> np.ndarray:
    lowered = LOWER[block.data]
    starts, ends, bounds = block.words(VISIBLE)
    size = np.maximum(np.diff(block.offsets), 1).astype(float)
    n = np.maximum(np.diff(bounds), 1).astype(float)
    parts = [_sums(kind[block.data], block.offsets) / size for kind in _CLASSES]
    words = word_hashes(lowered, starts, ends)
    first = np.zeros(len(words), bool)
    first[bounds[:-1][bounds[:-1] < len(words)]] = True
    again = np.append(False, words[1:] == words[:-1])[:len(words)] & ~first
    lengths = ends - starts
    letters = np.append(0, np.cumsum(lowered != block.data))
    plain = np.append(0, np.cumsum(_CLASSES[1][lowered] | _CLASSES[3][lowered]))
    distinct, agree = _concentration(words, bounds)
    parts += [
        _sums(again, bounds) / n,
        _sums(lengths, bounds) / n / 10,
        np.sqrt(_sums(lengths.astype(float)**2, bounds) / n) / 10,
        _sums(plain[ends] - plain[starts] == 0, bounds) / n,
        _sums(letters[ends] - letters[starts] > 1, bounds) / n,
        distinct, np.sqrt(agree), np.log1p(np.diff(bounds)) / 10,
    ]
    return np.column_stack(parts)


def page_features(block: Block, batch: pa.RecordBatch) -> np.ndarray:
    lines = np.zeros(256, bool) | True
    lines[0x0A] = False
    starts, ends, bounds = block.words(lines)
    lengths = (ends - starts).astype(float)
    n = np.maximum(np.diff(bounds), 1).astype(float)
    mean = _sums(lengths, bounds) / n
    spread = np.sqrt(np.maximum(_sums(lengths**2, bounds) / n - mean**2, 0))
    distinct, agree = _concentration(word_hashes(block.data, starts, ends), bounds)
    rows = slice(block.first, block.first + len(block))
    stated = np.nan_to_num(column_of(batch, "n_chars").cast(pa.float64()).to_numpy(
        zero_copy_only=False)[rows].astype(float))
    size = np.diff(block.offsets)
    parts = [np.log1p(np.maximum(stated, 0)) / 10, np.log1p(n), np.log1p(mean) / 5,
             spread / (mean + 1), 1 - distinct, agree,
             np.log1p(size) / 10 - np.log1p(np.maximum(stated, 0)) / 10]
    for name in ("source", "lang"):
        slots = batch.column(batch.schema.get_field_index(f"_{name}")).to_numpy(
            zero_copy_only=False)[rows]
        parts += [(slots == k).astype(float) for k in range(HASHED)]
    return np.column_stack(parts)


def _described_by(docs: DataFrame) -> dict[str, Column]:
    """What the features of a document are made of."""
    def slot(name):
        return F.coalesce(F.pmod(F.hash(F.lower(name)), F.lit(HASHED)), F.lit(-1))

    return {"text": F.col("text"), "n_chars": F.col("n_chars").cast("double"),
            "_source": slot("source"), "_lang": slot("lang")}


def described(docs: DataFrame) -> DataFrame:
    """Both views of every document as arrays of numbers. Nulls count as empty or 0."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros((batch.num_rows, CONTENT + PAGE), np.float32)
            for block in blocks(column_of(batch, "text")):
                rows[block.first:block.first + len(block)] = np.hstack(
                    [content_features(block), page_features(block, batch)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"),
                 pa.FixedSizeListArray.from_arrays(
                     pa.array(rows.ravel()), CONTENT + PAGE).cast(pa.list_(pa.float32()))],
                ["_row", "doc_id", "views"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(
        F.xxhash64("doc_id", "text", "lang", "source", "n_chars").alias("_row"), "doc_id",
        *(value.alias(name) for name, value in _described_by(docs).items()),
    ).mapInArrow(describe, f"_row long, doc_id {kind}, views array<float>")


def fit_logistic(rows: np.ndarray, marks: np.ndarray, penalty: float = 5e-3,
                 steps: int = 25) -> np.ndarray:
    """Weights (intercept last) by Newton's method; without both kinds, the constant."""
    x = np.column_stack([rows, np.ones(len(rows))])
    weights = np.zeros(x.shape[1])
    rate = (marks.sum() + 1) / (len(marks) + 2)
    weights[-1] = np.log(rate / (1 - rate))
    if not len(marks) or marks.all() or not marks.any():
        return weights
    ridge = np.append(np.full(rows.shape[1], penalty), 1e-9) * len(rows)
    for _ in range(steps):
        chance = _sigmoid(x @ weights)
        slope = x.T @ (chance - marks) + ridge * weights
        curve = (x * (chance * (1 - chance) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        change = np.linalg.solve(curve, slope)
        weights -= np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-6:
            break
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class View:
    """One view's scale, classifier and calibration."""

    def __init__(self, columns: slice, rows: np.ndarray, marks: np.ndarray):
        self.columns = columns
        own = rows[:, columns]
        self.mean, self.scale = own.mean(axis=0), own.std(axis=0) + 1e-3
        self.weights = fit_logistic((own - self.mean) / self.scale, marks)
        self.slope, self.shift, self.share = 1.0, 0.0, 1.0

    def logits(self, rows: np.ndarray) -> np.ndarray:
        own = np.clip((rows[:, self.columns] - self.mean) / self.scale, -20, 20)
        return own @ self.weights[:-1] + self.weights[-1]

    def calibrate(self, rows: np.ndarray, marks: np.ndarray) -> None:
        """Platt scaling; the view's share is how far it beats a constant guess."""
        if not len(marks) or marks.all() or not marks.any():
            return
        raw = self.logits(rows)
        self.slope, self.shift = fit_logistic(raw[:, None], marks, penalty=1e-4)
        chance = np.clip(_sigmoid(self.slope * raw + self.shift), 1e-6, 1 - 1e-6)
        rate = marks.mean()
        loss = -np.mean(np.where(marks, np.log(chance), np.log(1 - chance)))
        guess = -(rate * np.log(rate) + (1 - rate) * np.log(1 - rate))
        self.share = max(1e-3, 1 - loss / guess)

    def calibrated(self, rows: np.ndarray) -> np.ndarray:
        return self.slope * self.logits(rows) + self.shift


def _matrix(table: pa.Table, name: str = "views") -> np.ndarray:
    values = table.column(name).combine_chunks()
    if not len(values):
        return np.zeros((0, CONTENT + PAGE))
    return values.values.to_numpy().reshape(len(values), -1).astype(float)


PICKED = "view int, logit double, _row long, doc_id {kind}, views array<float>"


def surest(table: DataFrame, taken: pa.Table, views: list[View], count: int) -> list[pa.Table]:
    """For each view the ``count`` documents without label that it is surest are good, and as
    many that are bad, of all documents that are not ``taken``; at most ``2 * count`` rows.

    One sweep serves all views and both ends: every task keeps its own surest rows, equal
    ones once, and only those are compared between tasks.
    """
    kind = table.schema["doc_id"].dataType.simpleString()
    rows_taken, ids_taken = taken.column("_row"), taken.column("doc_id").drop_null()

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[pa.Table] = [None] * (2 * len(views))
        for batch in batches:
            own = pa.Table.from_batches([batch])
            for used, name in ((rows_taken, "_row"), (ids_taken, "doc_id")):
                if len(used):
                    own = own.filter(pc.invert(pc.fill_null(
                        pc.is_in(own.column(name), value_set=used.combine_chunks()), False)))
            features = _matrix(own)
            for k, view in enumerate(views):
                logits = view.logits(features)
                for end, sign in enumerate((1, -1)):
                    fit = own.filter(pa.array(sign * logits > 0)).append_column(
                        "rank", pa.array(-sign * logits[sign * logits > 0]))
                    at = 2 * k + end
                    every = fit if best[at] is None else pa.concat_tables([best[at], fit])
                    order = np.lexsort((every.column("_row"), every.column("rank")))
                    row = every.column("_row").to_numpy()[order]
                    fresh = np.append(True, row[1:] != row[:-1])[:len(row)]
                    best[at] = every.take(order[fresh][:count])
        for at, kept in enumerate(best):
            if kept is not None and len(kept):
                sign = -1.0 if at % 2 == 0 else 1.0
                yield from pa.table({
                    "view": pa.array([at // 2] * len(kept), pa.int32()),
                    "logit": pc.multiply(kept.column("rank"), sign),
                    **{n: kept.column(n) for n in ("_row", "doc_id", "views")}}).to_batches()

    kept = written(table.filter("quality is null").select("_row", "doc_id", "views").mapInArrow(
        pick, PICKED.format(kind=kind)).dropDuplicates(["view", "_row"]), "quality-surest")
    ends = [kept.filter(f"view = {k} and logit {sign} 0").orderBy(order, "_row").limit(count)
            for k in range(len(views))
            for sign, order in ((">", F.desc("logit")), ("<", F.asc("logit")))]
    found = reduce(DataFrame.unionByName, ends).orderBy("view", "logit", "_row").toArrow()
    return [found.filter(pc.equal(found.column("view"), k)) for k in range(len(views))]


def train(described_docs: DataFrame, labelled: int = LABELLED,
          rounds: int = ROUNDS, per_round: int = PER_ROUND) -> list[View]:
    """Co-train both views on documents with their views and, where known, ``quality``. At
    most ``labelled`` labelled documents are used, taken by hash of their ids; a fifth of
    them is kept for calibration. In each of ``rounds`` rounds each view hands the other at most ``2 * per_round`` documents, the surest of all that
    have no label, and no more than a fifth of the labelled ones."""
    table = described_docs.filter("quality is not null").orderBy(
        F.xxhash64(F.lit("quality"), "doc_id"), "doc_id", "_row").limit(labelled).select(
        "_row", "views", "quality").toArrow().sort_by("_row")
    rows = _matrix(table)
    marks = np.array(table.column("quality").to_pylist(), float) > 0
    held = np.arange(len(marks)) % 5 == 0
    columns = (slice(0, CONTENT), slice(CONTENT, CONTENT + PAGE))
    pools = [(rows[~held], marks[~held]) for _ in columns]
    if not len(marks):
        pools = [(np.zeros((1, CONTENT + PAGE)), np.ones(1, bool)) for _ in columns]
    views = [View(c, *pool) for c, pool in zip(columns, pools, strict=True)]
    gift_size = min(per_round, len(marks) // 10)
    empty = described_docs.select("_row", "doc_id").limit(0).toArrow()
    taken = empty
    for _ in range(rounds if gift_size else 0):
        gifts = surest(described_docs, taken, views, gift_size)
        for k, gift in enumerate(gifts):
            other = 1 - k
            logits = np.array(gift.column("logit").to_pylist(), float)
            pools[other] = (np.vstack([pools[other][0], _matrix(gift)]),
                            np.append(pools[other][1], logits > 0))
        given = pa.concat_tables([g.select(["_row", "doc_id"]).cast(empty.schema) for g in gifts])
        if not len(given):
            break
        taken = pa.concat_tables([taken, given])
        views = [View(c, *pool) for c, pool in zip(columns, pools, strict=True)]
    for view in views:
        view.calibrate(rows[held], marks[held])
    return views


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                  **training: int) -> DataFrame:
    """Add ``content_score``, ``page_score``, ``score`` (0 to 1, higher is better) and
    ``good`` (score of at least ``threshold``) to ``docs``.

    Null text, language, source and length count as empty or unknown. Repeated rows get
    equal scores. Without labels every document is good. Labels without a document are
    not used; ids labelled twice count as good if any label says so.
    """
    names = ("content_score", "page_score", "score", "good")
    own = [c for c in docs.columns if c not in names]
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    views = train(written(described(docs).join(known, "doc_id", "left"), "quality-views"),
                  **training)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, CONTENT + PAGE))
            for block in blocks(column_of(batch, "text")):
                found[block.first:block.first + len(block)] = np.hstack(
                    [content_features(block), page_features(block, batch)]).astype(np.float32)
            logits = [view.calibrated(found) for view in views]
            shares = np.array([view.share for view in views])
            both = sum(s * x for s, x in zip(shares / shares.sum(), logits, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(_sigmoid(x)) for x in (*logits, both))],
                ["row", *names[:3]])

    ready = packed(docs.select(*own), **_described_by(docs))
    schema = T.StructType([ready.schema["row"]] + [T.StructField(n, T.DoubleType()) for n in names[:3]])
    scored = ready.mapInArrow(score, schema).withColumn("good", F.col("score") >= threshold)
    return scored.select(*(F.col("row").getField(c).alias(c) for c in own), *names)
