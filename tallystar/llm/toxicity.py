"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; other text is unlabelled, toxic documents
among it included. The risk of a classifier is prior * (loss of positives as positive) +
max(0, loss of unlabelled as negative - prior * loss of positives as negative): the
bracket is the risk on negatives that were never seen, and where it falls below zero, the
step goes back instead, so that the classifier does not explain away the positives hidden
in the unlabelled text.

The unlabelled side is all text outside the held-out fold, in sums that Spark adds up:

- how many documents have each feature, which chooses features and bounds the prior;
- the second moments of the chosen features, which is all that the squared loss of a linear
  classifier needs, so several are trained with numpy without going through the text again;
- how many documents get each value of their mean, over which a slope and an intercept are
  trained in the same way under logistic loss, which makes the value a probability.

Only the positives are a bounded sample. Every document is scored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.blocks import ALPHANUMERIC, LOWER, Block, blocks, column_of, word_hashes
from tallystar.llm.shared import written

BITS = 18
STEM_BYTES = (4, 5, 6)
POSITIVES = 5000
FEATURES = 768  # width of the linear classifiers
CLASSIFIERS = 3
STEPS = 600
PENALTY = 1e-4
LEAST_DEVIATIONS = 4.0
BINS = 4096  # values of the linear mean that are told apart
ROWS_AT_ONCE = 2048
ADDERS = 32


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids have none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each document (words and their beginnings, hashed), in one
    array, and the bounds of each document in it."""
    data = LOWER[block.data]
    starts, ends, bounds = block.words(ALPHANUMERIC)
    families = [word_hashes(data, starts, ends)]
    families += [word_hashes(data, starts, np.minimum(starts + n, ends)) for n in STEM_BYTES]
    owner = np.repeat(np.arange(len(block)), np.diff(bounds)).astype(np.uint64)
    width = np.uint64(BITS + 2)
    keys = np.concatenate([
        (owner << width) | np.uint64(k << BITS) | (family >> np.uint64(64 - BITS))
        for k, family in enumerate(families)])
    keys = np.sort(keys)
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    cuts = np.searchsorted(keys, np.arange(len(block) + 1, dtype=np.uint64) << width)
    return (keys & np.uint64((1 << (BITS + 2)) - 1)).astype(np.int32), cuts


def _found(docs: DataFrame) -> DataFrame:
    """The features of each document, as bytes, beside its id."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block in blocks(column_of(batch, "text")):
                found, cuts = features(block)
                rows += [found[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(extract, f"doc_id {kind}, found binary")


def _frequencies(docs: DataFrame, wanted: np.ndarray) -> tuple[np.ndarray, int]:
    """How many documents have each wanted feature, and how many documents there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(wanted), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for block in blocks(column_of(batch, "text")):
                found, _ = features(block)
                total += np.bincount(found, minlength=len(wanted))
        at = np.flatnonzero(wanted & (total > 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], ["feature", "n"])

    rows = docs.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(
        F.sum("n").alias("n")).toArrow()  # at most one row a feature
    at, n = (rows.column(c).to_numpy() for c in ("feature", "n"))
    total = np.zeros(len(wanted), np.int64)
    total[at[at >= 0]] = n[at >= 0]
    return total, int(n[at < 0].sum())


def _matrix(found: list[np.ndarray], place: np.ndarray, width: int) -> np.ndarray:
    """One row of zeros and ones for each document, a last column of ones beside."""
    out = np.zeros((len(found), width + 1))
    out[:, width] = 1
    for i, own in enumerate(found):
        kept = place[own]
        out[i, kept[kept >= 0]] = 1
    return out


def _chosen(docs: DataFrame, place: np.ndarray) -> DataFrame:
    """The chosen features of each document, as a written table."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block in blocks(column_of(batch, "text")):
                found, cuts = features(block)
                own = place[found]
                rows += [x[x >= 0].astype(np.int16).tobytes() for x in np.split(own, cuts[1:-1])]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["kept"])

    return written(docs.select("text").mapInArrow(extract, "kept binary"), "toxicity-features")


def _added(table: DataFrame, shape: tuple[int, ...], part_of) -> np.ndarray:
    """The sum over all rows of a table of arrays of one shape; ``part_of`` gives that of some
    rows. Tasks add up their own, a few tasks add up those."""

    def fold_rows(batches: Iterator[pa.RecordBatch], add) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += add(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sum"])

    def of_sums(batch: pa.RecordBatch) -> np.ndarray:
        return sum((np.frombuffer(x).reshape(shape) for x in batch.column(0).to_pylist()),
                   np.zeros(shape))

    first = table.mapInArrow(lambda rows: fold_rows(rows, part_of), "sum binary")
    second = first.repartition(ADDERS).mapInArrow(lambda rows: fold_rows(rows, of_sums), "sum binary")
    return sum((np.frombuffer(r["sum"]).reshape(shape) for r in second.collect()), np.zeros(shape))


def _kept_rows(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int16) for x in batch.column("kept").to_pylist()]


def _moments(table: DataFrame, width: int) -> np.ndarray:
    """Sum over all documents of the products of each two of their columns, ones included."""
    same = np.arange(width)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        rows, total = _kept_rows(batch), np.zeros((width + 1, width + 1))
        for at in range(0, len(rows), ROWS_AT_ONCE):
            own = _matrix(rows[at:at + ROWS_AT_ONCE], same, width)
            total += own.T @ own
        return total

    return _added(table, (width + 1, width + 1), products)


def _values(rows: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """What a linear classifier gives documents; its last weight is the intercept."""
    lengths = np.array([len(r) for r in rows], np.int64)
    sums = np.append(0.0, np.cumsum(weights[np.concatenate(rows)] if len(rows) else []))
    ends = np.cumsum(lengths)
    return sums[ends] - sums[ends - lengths] + weights[-1]


def _bins(values: np.ndarray) -> np.ndarray:
    """Bins of values from -4 to 4, what lies beyond in the last ones."""
    return np.clip(((values + 4) * (BINS / 8)).astype(np.int64), 0, BINS - 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _descend(gradient_of, width: int, steps: int, rate: float) -> np.ndarray:
    """Full-batch Adam from zero."""
    weights, first, second = np.zeros(width), np.zeros(width), np.zeros(width)
    for step in range(1, steps + 1):
        gradient = gradient_of(weights)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        weights = weights - rate * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights


def squared_risk(weights: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float):
    """Positive and negative part of the risk under squared loss, from mean second moments
    whose last row are the means, and their gradients."""
    p, u = positive @ weights, unlabelled @ weights
    as_positive = 1 - 2 * p[-1] + weights @ p
    p_negative, u_negative = 1 + 2 * p[-1] + weights @ p, 1 + 2 * u[-1] + weights @ u
    return (prior * as_positive / 4, (u_negative - prior * p_negative) / 4,
            prior * (p - positive[-1]) / 2,
            (u + unlabelled[-1] - prior * (p + positive[-1])) / 2)


def logistic_risk(line: np.ndarray, values: np.ndarray, positive: np.ndarray,
                  unlabelled: np.ndarray, prior: float):
    """The same under logistic loss for slope and intercept over the shares of values."""
    score = line[0] * values + line[1]
    chance = _sigmoid(score)
    loss, anti = np.logaddexp(0, score), np.logaddexp(0, -score)
    pull_p, pull_n = prior * positive * (chance - 1), (unlabelled - prior * positive) * chance
    return (prior * (positive * anti).sum(), ((unlabelled - prior * positive) * loss).sum(),
            np.array([pull_p @ values, pull_p.sum()]), np.array([pull_n @ values, pull_n.sum()]))


def non_negative(risk, penalty: float):
    """The gradient to go by: of the whole risk, and back where its negative part is below
    zero, which no classifier's can be."""
    def gradient(weights: np.ndarray) -> np.ndarray:
        _, negative, pull_p, pull_n = risk(weights)
        return (pull_p + pull_n if negative >= 0 else -pull_n) + penalty * weights
    return gradient


def estimated_prior(with_p: np.ndarray, n_p: int, with_u: np.ndarray, n_u: int) -> float:
    """The largest share of positives that the unlabelled text leaves room for: any feature
    is at least as frequent there as the prior times its frequency among positives. Only
    features that many positives have speak."""
    common = with_p >= max(3, 0.2 * n_p)
    room = (with_u[common] + 1) / (n_u + 1) / (with_p[common] / n_p)
    return float(np.clip(room.min() if len(room) else 0.5, 1 / (n_u + 1), 0.5))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES,
          prior: float | None = None) -> tuple[np.ndarray, float]:
    """Weights of all features and intercept, learnt from documents outside fold 0: at most
    ``positives`` toxic ones, taken by hash of their ids, and all as unlabelled.

    ``prior`` is the share of toxic ones among those; by default their share among labelled
    rows that also name clean ones, and without clean ones an estimate from the text. Only
    features whose share among the positives is several standard deviations above that in
    all text are kept, the ``FEATURES`` furthest of them. Without positives all scores are
    near 0."""
    outside = F.coalesce(fold(F.col("doc_id")) != 0, F.lit(False))
    known = labels.filter(outside).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count("toxic"), F.sum("toxic")).first()
    weights = np.zeros(1 << (BITS + 2), np.float32)
    text = docs.filter(outside)
    mark = F.xxhash64(F.lit("toxicity"), "doc_id")
    # The bound on the positives bounds what is broadcast and brought to the driver.
    yes = known.filter("toxic = 1").orderBy(mark, "doc_id").limit(positives).select("doc_id")
    sample = _found(text.select("doc_id", "text").join(F.broadcast(yes), "doc_id")).toArrow()
    found = sorted(sample.column("found").to_pylist())
    found = [np.frombuffer(x, np.int32) for x in found]
    if not toxic or not any(len(x) for x in found):
        return weights, -8.0
    n_p = len(found)
    with_p = np.bincount(np.concatenate(found), minlength=len(weights))
    with_u, n_u = _frequencies(text, with_p >= min(3, n_p))
    if prior is None:
        prior = toxic / n if toxic < n else estimated_prior(with_p, n_p, with_u, n_u)
    share = (with_p + with_u + 1.0) / (n_p + n_u + 2.0)
    spread = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    gain = (with_p / n_p - with_u / n_u) / spread
    gain[with_p < min(3, n_p)] = 0
    best = np.argsort(-gain, kind="stable")[:FEATURES]
    chosen = np.sort(best[gain[best] > LEAST_DEVIATIONS])
    if not len(chosen):
        return weights, float(np.log(prior / (1 - prior)))
    place = np.full(len(weights), -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    table = _chosen(text, place)
    width = len(chosen)
    unlabelled = _moments(table, width) / n_u
    rows, rng = _matrix(found, place, width), np.random.RandomState(0)
    fits = []
    for _ in range(CLASSIFIERS):
        draw = rng.multinomial(n_p, np.full(n_p, 1 / n_p)) / n_p
        positive = rows.T @ (rows * draw[:, None])
        fits.append(_descend(non_negative(
            lambda w, p=positive: squared_risk(w, p, unlabelled, prior), PENALTY),
            width + 1, STEPS, 0.02))
    linear = np.mean(fits, axis=0)

    def histogram(batch: pa.RecordBatch) -> np.ndarray:
        return np.bincount(_bins(_values(_kept_rows(batch), linear)), minlength=BINS).astype(float)

    in_bins = _added(table, (BINS,), histogram) / n_u
    positive = np.bincount(_bins(rows @ linear), minlength=BINS) / n_p
    middles = (np.arange(BINS) + 0.5) * (8 / BINS) - 4
    slope, intercept = _descend(non_negative(
        lambda line: logistic_risk(line, middles, positive, in_bins, prior), 1e-6),
        2, 4 * STEPS, 0.05)
    weights[chosen] = slope * linear[:-1]
    return weights, float(slope * linear[-1] + intercept)


def score_toxicity(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``doc_id``, ``held_out`` (fold 0), ``score`` (0 to 1) and ``predicted`` of every row.

    Only texts are scored; labels, language and source are not looked at. Null and empty
    texts get the score of a text without words. Repeated rows get equal scores. Labels
    without a document and labels or documents without an id are not learnt from.
    """
    weights, bias = train(docs, labels, **how)
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt, start = model.value
        for batch in batches:
            scores = np.full(batch.num_rows, start)
            for block in blocks(column_of(batch, "text")):
                found, cuts = features(block)
                sums = np.concatenate([[0.0], np.cumsum(learnt[found], dtype=np.float64)])
                scores[block.first:block.first + len(block)] += sums[cuts[1:]] - sums[cuts[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_sigmoid(scores))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
