"""Language-model scores from a probabilistic suffix tree over bytes.

A text is spelled as its lower-case words, each followed by a space, and an end mark. The
tree holds contexts of up to ``DEPTH`` bytes. A context seen ``LEAST_COUNT`` times is kept
if the bytes that follow it diverge significantly from what its longest kept suffix
predicts; nothing else prunes, at any corpus size. What follows a context is smoothed
towards that suffix. A byte's probability is that of the longest kept context before it.

The tree is never in one place. Every chunk of documents sends its distinct stretches of a
context and the byte after it, with their counts in the texts learnt from, to where the
last ``TOP + 1`` bytes of the context are dealt: with all longer contexts that end so, a
task has a whole branch of the tree. It grows the branch, and answers each stretch with its
probability. Shorter contexts than a branch's root, at most 256 ** ``TOP``, are counted
first and broadcast. Chunks go to a branch in groups that are added up on the way, so a
frequent branch gets distinct stretches, not all chunks' ones.

The unigram figures beside the score (how often each word was seen) come from exact counts
over the whole corpus, exchanged in the same way.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.blocks import LOWER, VISIBLE, Block, blocks, column_of, mixed, word_hashes
from tallystar.llm.shared import once, written

DEPTH = 6
TOP = 2
LEAST_COUNT = 12
CHUNK_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20
TEAM_CHUNKS = 64
SPACE, END, PAD = 0x20, 0x0A, 0x00

_EIGHT = np.uint64(8)


def spelled(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All documents as bytes, each after ``DEPTH`` pads; where each begins and ends, and
    where each word ends (its space included)."""
    starts, ends, bounds = block.words(VISIBLE)
    lengths = ends - starts
    total = np.append(0, np.cumsum(lengths + 1))
    sizes = total[bounds[1:]] - total[bounds[:-1]] + 1
    heads = np.cumsum(sizes + DEPTH) - sizes
    out = np.zeros(int((sizes + DEPTH).sum()), np.uint8)
    owner = np.repeat(np.arange(len(block)), np.diff(bounds))
    at = heads[owner] + total[:-1] - total[bounds[owner]]
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(at, lengths) + place] = LOWER[block.data[np.repeat(starts, lengths) + place]]
    out[at + lengths] = SPACE
    out[heads + sizes - 1] = END
    return out, heads, heads + sizes, at + lengths + 1


def stretches(out: np.ndarray) -> np.ndarray:
    """At each place the ``DEPTH`` bytes before it, the nearest highest, and its own lowest."""
    keys = out.astype(np.uint64)
    for back in range(1, DEPTH + 1):
        keys[back:] |= out[:-back].astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - back))
    return keys


def _real(out: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Which places are not pads."""
    real = np.ones(len(out), bool)
    real[(heads[:, None] - np.arange(1, DEPTH + 1)).ravel()] = False
    return real


def _distinct(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[:len(keys)]
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def _pack(values: np.ndarray) -> bytes:
    """Numbers, compressed byte by byte: most of their high bytes are alike."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(
        planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    width, count = np.dtype(kind).itemsize, int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(
        packed[8:], decompressed_size=width * count, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, count).T).view(kind).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending numbers as differences."""
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, np.uint64), dtype=np.uint64)


def _branch(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that the branch of each stretch is dealt to."""
    return (mixed(keys >> np.uint64(8 * (DEPTH - TOP))) % np.uint64(parts)).astype(np.int64)


def _cuts(part: np.ndarray, parts: int) -> list[tuple[int, slice]]:
    """Slices of the parts that occur in an ascending array of parts."""
    edges = np.searchsorted(part, np.arange(parts + 1))
    return [(p, slice(edges[p], edges[p + 1])) for p in range(parts) if edges[p] < edges[p + 1]]


# --- the tree ---------------------------------------------------------------------------


def _shorter(codes: np.ndarray) -> np.ndarray:
    """The same stretches without the farthest byte of their context."""
    return ((codes >> np.uint64(16)) << _EIGHT) | (codes & np.uint64(255))


def _followed(codes: np.ndarray, counts: np.ndarray, base: np.ndarray):
    """Probabilities of sorted (context, byte) ``codes`` from their counts and from those the
    next shorter contexts give (``base``), and which contexts are kept."""
    if not len(codes):
        return base, np.zeros(0, bool), codes
    context = codes >> _EIGHT
    heads = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    sizes = np.diff(np.append(heads, len(codes)))
    total = np.add.reduceat(counts, heads)
    symbols = np.add.reduceat((counts > 0).astype(np.int64), heads)
    each = np.repeat(total, sizes)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(counts > 0, counts * np.log(counts / each / base), 0.0)
    divergence = 2 * np.add.reduceat(gain, heads)
    keep = (total >= LEAST_COUNT) & (divergence > 20 + 2 * symbols)
    weight = np.repeat(symbols, sizes)
    smoothed = (counts + weight * base) / np.maximum(each + weight, 1)
    return np.where(np.repeat(keep, sizes), smoothed, base), keep, context[heads]


def grow(codes: np.ndarray, counts: np.ndarray, depth: int, root: int, base_of):
    """Probability of each of sorted (context of ``depth`` bytes, byte) ``codes``, and the
    kept contexts by their length. ``base_of`` gives the probabilities at ``root`` bytes."""
    levels = [(codes, counts, None)]
    for _ in range(depth - root - 1):
        found, place = np.unique(_shorter(levels[-1][0]), return_inverse=True)
        sums = np.bincount(place, levels[-1][1], len(found)).astype(np.int64)
        levels.append((found, sums, place))
    value = base_of(_shorter(levels[-1][0]))
    kept = {}
    for up in range(len(levels) - 1, -1, -1):
        own, sums, _ = levels[up]
        value, keep, contexts = _followed(own, sums, value)
        kept[depth - up] = contexts[keep]
        if up:
            value = value[levels[up][2]]
    return value, kept


def top_of(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Probabilities after contexts of ``TOP`` bytes, for sorted distinct ``codes``."""
    root = np.zeros(256)
    np.add.at(root, (codes & np.uint64(255)).astype(np.int64), counts)
    chance = (root + 0.5) / (root.sum() + 128.0)
    return grow(codes, counts, TOP, 0, lambda short: chance[short.astype(np.int64)])[0]


# --- what chunks exchange ---------------------------------------------------------------


def _chunk_words(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
    """Words of a chunk's documents: hashes end to end, bounds, and the blocks."""
    hashes, bounds, cut = [], [np.zeros(1, np.int64)], []
    at = 0
    for block in blocks(column_of(table, "text"), BLOCK_BYTES):
        starts, ends, own = block.words(VISIBLE)
        hashes.append(word_hashes(LOWER[block.data], starts, ends))
        bounds.append(own[1:] + at)
        at += len(starts)
        cut.append(block)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
            np.concatenate(bounds), cut)


GRAMS, WORDS, SHORT = range(3)
SENT = "kind int, part int, chunk long, keys binary, counts binary"
_SENT = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("chunk", pa.int64()),
                   ("keys", pa.binary()), ("counts", pa.binary())])


def _dealt(kind: int, keys: np.ndarray, counts: np.ndarray, part: np.ndarray,
           parts: int) -> list[tuple]:
    """Rows with the ascending keys of each part. They are put in order once, not for each
    part: there are as many parts as chunks."""
    order = np.argsort(part, kind="stable")
    keys, counts = keys[order], counts[order]
    return [(kind, p, _pack_sorted(keys[own]), _pack(counts[own]))
            for p, own in _cuts(part[order], parts)]


def _looked_up(known: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of ascending ``known`` keys for keys in any order. They are looked up in theirs:
    neighbours are near each other in memory, which is several times quicker."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted), values.dtype)
    out[order] = values[np.searchsorted(known, wanted[order])]
    return out


def _sent(rows: DataFrame, parts: int) -> DataFrame:
    """What each chunk sends: its distinct stretches by branch, its distinct words and its
    counts of the shortest contexts, all with how often they were learnt."""

    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunk, out = key[0].as_py(), []
        times = np.where(column_of(table, "learnt").to_numpy(zero_copy_only=False),
                         column_of(table, "times").to_numpy(zero_copy_only=False), 0)
        words, bounds, cut = _chunk_words(table)
        found, counts = _distinct(words, np.repeat(times, np.diff(bounds)).astype(np.int64))
        part = (found % np.uint64(parts)).astype(np.int64)
        out += _dealt(WORDS, found, counts, part, parts)
        # Stretches that count alike are sorted together, which is quicker than sorting pairs.
        alike: dict[int, list[np.ndarray]] = {}
        for block in cut:
            text, heads, tails, _ = spelled(block)
            own = stretches(text)[_real(text, heads)]
            weights = times[block.first:block.first + len(block)]
            each = np.repeat(weights, tails - heads)
            for weight in np.unique(weights):
                alike.setdefault(int(weight), []).append(own[each == weight])
        sums = []
        for weight in sorted(alike):
            own = np.concatenate(alike.pop(weight))
            own.sort()
            edges = np.flatnonzero(np.append(True, own[1:] != own[:-1]))[:len(own)]
            sums.append((own[edges], weight * np.diff(np.append(edges, len(own)))))
        keys, counts = _distinct(np.concatenate([k for k, _ in sums]),
                                 np.concatenate([c for _, c in sums]).astype(np.int64))
        out += _dealt(GRAMS, keys, counts, _branch(keys, parts), parts)
        short = (keys >> np.uint64(8 * (DEPTH + 1 - TOP)) << _EIGHT) | (keys & np.uint64(255))
        found, counts = _distinct(short, counts)
        out.append((SHORT, -1, _pack_sorted(found), _pack(counts)))
        kinds, part, keys, counts = zip(*out, strict=True)
        return pa.table([kinds, part, [chunk] * len(out), keys, counts], schema=_SENT)

    return rows.groupBy("chunk").applyInArrow(send, SENT)


def _top(sent: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shortest contexts with the bytes after them, and their probabilities."""

    def spread(batches):
        for batch in batches:
            found, counts = _added(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int64)), pa.array(counts)], ["code", "n"])

    # At most 256 ** (TOP + 1) rows; about twenty thousand for text.
    rows = sent.filter(F.col("kind") == SHORT).select("keys", "counts").mapInArrow(
        spread, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    codes, counts = _distinct(rows.column("code").to_numpy().astype(np.uint64),
                              rows.column("n").to_numpy().astype(np.int64))
    return codes, top_of(codes, counts)


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all rows and the sums of their counts."""
    keys = [_unpack_sorted(k) for k in table.column("keys").to_pylist()]
    counts = [_unpack(c, np.int64) for c in table.column("counts").to_pylist()]
    return _distinct(np.concatenate(keys or [np.zeros(0, np.uint64)]),
                     np.concatenate(counts or [np.zeros(0, np.int64)]))


def _answers(grams: DataFrame, codes, values, parts: int) -> DataFrame:
    """``chunk``, ``part`` and the log10 probabilities of the stretches it sent there. Teams of
    chunks are added up before they meet at a branch, about as many as there are in a team."""
    top = grams.sparkSession.sparkContext.broadcast((codes, values))
    team = max(TEAM_CHUNKS, math.isqrt(parts))
    grouped = grams.withColumn("team", F.floor(F.col("chunk") / team).cast("long"))

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, counts = _added(table)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                         "team": pa.array([key[1].as_py()], pa.int64()),
                         "keys": [_pack_sorted(keys)], "counts": [_pack(counts)]})

    def learn(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        known, chance = top.value
        keys, counts = _added(table)
        value, _ = grow(keys, counts, DEPTH, TOP,
                        lambda short: chance[np.searchsorted(known, short)])
        logs = np.log10(value).astype(np.float32)
        return pa.table({
            "part": table.column("part"), "team": table.column("team"),
            "logs": [_pack(logs[np.searchsorted(keys, _unpack_sorted(own))])
                     for own in table.column("keys").to_pylist()]})

    def reply(key, ours: pa.Table, theirs: pa.Table) -> pa.Table:
        own = [_unpack_sorted(k) for k in ours.column("keys").to_pylist()]
        every = np.unique(np.concatenate(own))
        logs = _unpack(theirs.column("logs")[0].as_py(), np.float32)
        return pa.table({
            "chunk": ours.column("chunk"), "part": ours.column("part"),
            "logs": [_pack(logs[np.searchsorted(every, k)]) for k in own]})

    teams = grouped.groupBy("part", "team").applyInArrow(
        add, "part int, team long, keys binary, counts binary")
    learnt = teams.groupBy("part").applyInArrow(learn, "part int, team long, logs binary")
    return grouped.groupBy("part", "team").cogroup(learnt.groupBy("part", "team")).applyInArrow(
        reply, "chunk long, part int, logs binary")


def _word_totals(counts: DataFrame) -> DataFrame:
    """Totals of the words that more than one chunk has, for each chunk that has them;
    for chunk -1 the numbers of distinct words, of tokens learnt from and of words seen once."""

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunks = table.column("chunk").to_pylist()
        words = [_unpack_sorted(x) for x in table.column("keys").to_pylist()]
        counts = [_unpack(x, np.int64) for x in table.column("counts").to_pylist()]
        found, place, times = np.unique(
            np.concatenate(words), return_inverse=True, return_counts=True)
        sums = np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64)
        rows = [(-1, b"", b"", int((sums > 0).sum()), int(sums.sum()), int((sums == 1).sum()))]
        at = 0
        for chunk, own in zip(chunks, words, strict=True):
            index = place[at:at + len(own)]
            index = index[times[index] > 1]
            rows.append((chunk, _pack_sorted(found[index]), _pack(sums[index]), 0, 0, 0))
            at += len(own)
        names = ("chunk", "words", "totals", "distinct", "tokens", "once")
        return pa.Table.from_pylist(
            [dict(zip(names, row, strict=True)) for row in rows],
            pa.schema([("chunk", pa.int64()), ("words", pa.binary()), ("totals", pa.binary()),
                       ("distinct", pa.int64()), ("tokens", pa.int64()), ("once", pa.int64())]))

    return counts.groupBy("part").applyInArrow(
        add, "chunk long, words binary, totals binary, distinct long, tokens long, once long")


def word_log10(spelling: np.ndarray, known: np.ndarray, fresh: float) -> np.ndarray:
    """log10 probabilities of words from those of their spelling: at every place for a word
    it is another one than those learnt with probability ``fresh``, and else spelled out."""
    return np.where(known, spelling + math.log10(1 - fresh), math.log10(fresh))


def score_texts(docs: DataFrame, learnt: Column) -> DataFrame:
    """``doc_id``, ``learnt``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` of every row; the rows for which ``learnt`` holds are learnt from.

    ``base_score`` is the smoothed unigram log10 probability of the words and the end.
    ``score`` is the tree's, over the same symbols: the words learnt, each spelled out, one
    symbol for all other words, and the end, all spelled out unless the next word is another
    one. The other words' share is estimated by that of the words seen once (Good and
    Turing). A null text is empty and still has its end. Repeated rows count as often as
    they occur. If nothing is learnt, every byte is equally likely. Other columns are not read.
    """
    rows = docs.select("doc_id", "text", F.coalesce(learnt, F.lit(False)).alias("learnt"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / CHUNK_BYTES))
    single, again = once(rows, {"doc_id": F.col("doc_id"), "learnt": F.col("learnt"),
                                "one": F.xxhash64("text"), "two": F.xxhash64("text", F.lit(1))})
    chunked = single.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)))
    sent = written(_sent(chunked, parts), "suffix-tree-sent", compression="none")
    codes, values = _top(sent)
    totals = written(_word_totals(sent.filter(F.col("kind") == WORDS)), "word-totals")
    distinct, tokens, seen_once = totals.filter("chunk = -1").agg(
        F.sum("distinct"), F.sum("tokens"), F.sum("once")).first()
    fresh = ((seen_once or 0) + 0.5) / ((tokens or 0) + 1.0)
    ends = rows.filter("learnt").count()
    train_tokens = (tokens or 0) + ends
    scale = train_tokens + 0.5 * ((distinct or 0) + (ends > 0) + 1)
    answers = _answers(sent.filter(F.col("kind") == GRAMS).drop("kind"), codes, values, parts)

    def score(key, ours: pa.Table, theirs: pa.Table) -> pa.Table:
        words, bounds, cut = _chunk_words(ours)
        learnt_times = np.where(column_of(ours, "learnt").to_numpy(zero_copy_only=False),
                                column_of(ours, "times").to_numpy(zero_copy_only=False), 0)
        place, found = pd.factorize(words)
        seen = np.bincount(place, np.repeat(learnt_times, np.diff(bounds)), len(found))
        replies = theirs.to_pylist()
        shared = [r for r in replies if r["words"] is not None]
        if shared:
            names = np.concatenate([_unpack_sorted(r["words"]) for r in shared])
            order = np.argsort(found)
            seen[order[np.searchsorted(found, names, sorter=order)]] = np.concatenate(
                [_unpack(r["totals"], np.int64) for r in shared])
        logs = np.append(0.0, np.cumsum(np.log10((seen[place] + 0.5) / scale)))
        known = np.append(0, np.cumsum(seen[place] > 0))
        end = math.log10((ends + 0.5) / scale)

        spellings, stretched = [], []
        for block in cut:
            text, heads, tails, word_ends = spelled(block)
            real = _real(text, heads)
            numbers, found = pd.factorize(stretches(text)[real])
            stretched.append(found)
            spellings.append((numbers.astype(np.int32), real, heads, tails, word_ends))
        # Stretches are numbered block by block; those of all blocks are merged without repeats.
        every = np.concatenate(stretched)
        every.sort()
        every = every[np.flatnonzero(np.append(True, every[1:] != every[:-1]))[:len(every)]]
        order = np.argsort(_branch(every, parts), kind="stable")
        chance = np.empty(len(every), np.float32)
        chance[order] = np.concatenate([_unpack(r["logs"], np.float32) for r in sorted(
            (r for r in replies if r["logs"] is not None), key=lambda r: r["part"])])
        scores = np.zeros(ours.num_rows)
        for block, found, (numbers, real, heads, tails, word_ends) in zip(
                cut, stretched, spellings, strict=True):
            own = bounds[block.first:block.first + len(block) + 1]
            steps = np.zeros(len(real))
            steps[real] = _looked_up(every, chance, found)[numbers]
            total = np.append(0.0, np.cumsum(steps))
            before = np.append(0, word_ends)[:-1]
            first = np.diff(own) > 0
            before[own[:-1][first] - own[0]] = heads[first]
            word = word_log10(total[word_ends] - total[before],
                              seen[place[own[0]:own[-1]]] > 0, fresh)
            sums = np.append(0.0, np.cumsum(word))[own - own[0]]
            scores[block.first:block.first + len(block)] = (
                np.diff(sums) + total[tails] - total[tails - 1] + math.log10(1 - fresh))
        return pa.table({
            "doc_id": ours.column("doc_id"), "learnt": ours.column("learnt"),
            "one": ours.column("one"), "two": ours.column("two"),
            "n_tokens": np.diff(bounds) + 1,
            "n_known": known[bounds[1:]] - known[bounds[:-1]] + int(ends > 0),
            "base_score": logs[bounds[1:]] - logs[bounds[:-1]] + end,
            "score": scores})

    kind = docs.schema["doc_id"].dataType.simpleString()
    replies = answers.unionByName(
        totals.filter("chunk >= 0").select("chunk", "words", "totals"), allowMissingColumns=True)
    scored = chunked.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        score, f"doc_id {kind}, learnt boolean, one long, two long, n_tokens long, n_known long, "
               "base_score double, score double")
    return again(scored).select(
        "doc_id", "learnt", "n_tokens", "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
