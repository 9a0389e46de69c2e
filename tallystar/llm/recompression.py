"""Long repeated passages by recompression of token sequences.

Every text becomes a sequence of names, one for each word. A Spark round shortens all
sequences: runs of one name get a name, then neighbouring pairs whose first name is on the
left side and whose second is on the right side get one. The side of a name is a bit of its
hash; which of several bits holds in a round is settled for the whole corpus, by counting
over all sequences how many pairs each would name. A name is a hash of what it stands for,
so that the same run or pair gets the same name in every task without a dictionary that
would have to be moved around.

Equal passages are named alike except near their ends, where neighbours outside the passage
can take part. So each symbol carries its context: the stretch of words that fixes it. A
symbol whose context lies within a window stands in every copy of that window at the same
place. After the last round the longest symbol among those is the window's anchor, a window without
one is its own. Neighbouring windows with one anchor make a read. Spark counts the anchors
of all documents: windows of an anchor that occurs once are unique; if all reads of an
anchor are equal, their windows are repeated; the windows of other reads are compared one by
one, by 128 bits of hash.

Documents are dealt into chunks of bounded size as they are read, whatever they hold. A
chunk sends an anchor or window once however often it holds it, so that a passage in very
many documents sends one entry a chunk. Between rounds sequences are written tables.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.blocks import (
    VISIBLE, blocks, column_of, mixed, stretch_sums, word_hashes,
)
from tallystar.llm.shared import dropped, written

WINDOW = 35
ROUNDS = 4
CHUNK_BYTES = 4 << 20
SIDES = 4  # bits of a name's hash that a round chooses from

_RUN = np.uint64(0x9FB21C651E98DF25)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_SECOND = 0xA24BAED4963EE407
_MANY = np.uint64(0)
_FAR = 65535

# A chunk is one row; binary columns hold packed arrays.
TEXTS = "chunk long, ids array<bigint>, counts binary, vocabulary binary, codes binary"
SYMBOLS = "chunk long, names binary, lengths binary, before binary, after binary, heads binary"
GAINS = ", gains array<bigint>"
READS = "chunk long, anchors binary, owned binary, firsts binary, spans binary"


def _pack(values: np.ndarray) -> bytes:
    """An array, compressed; numbers below 8 bytes byte by byte, as most of theirs are zero."""
    raw = values.view(np.uint8)
    if 1 < values.itemsize < 8:
        raw = raw.reshape(-1, values.itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(
        raw.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    width, count = np.dtype(kind).itemsize, int.from_bytes(packed[:8], "little")
    raw = np.frombuffer(pa.decompress(
        packed[8:], decompressed_size=count * width, codec="zstd", asbytes=True), np.uint8)
    if 1 < width < 8:
        raw = np.ascontiguousarray(raw.reshape(width, count).T).ravel()
    return raw.view(kind)


class Symbols(NamedTuple):
    """Sequences of a chunk end to end: names, first words, context (first word, end) and
    which symbols begin a document. ``total`` is the number of words."""

    name: np.ndarray
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray
    head: np.ndarray
    total: int

    def follows(self, at: np.ndarray):
        """For symbols ``at``: the next one, and whether none follows in the document."""
        after = np.minimum(at + 1, len(self.name) - 1)
        return after, (at + 1 == len(self.name)) | self.head[after]

    def ends(self) -> np.ndarray:
        return np.append(self.start[1:], self.total)

    def pick(self, at, name, low, high) -> Symbols:
        return Symbols(name, self.start[at], low, high, self.head[at], self.total)


def word_symbols(names: np.ndarray, counts: np.ndarray) -> Symbols:
    place = np.arange(len(names), dtype=np.int32)
    head = np.zeros(len(names), bool)
    first = (np.cumsum(counts) - counts)[counts > 0]
    head[first] = True
    return Symbols(names, place, place, place + 1, head, len(names))


def name_runs(s: Symbols) -> Symbols:
    """One symbol for each run of a name. Its context reaches over both neighbours, which
    end the run, and beyond the document where there is none."""
    if not len(s.name):
        return s
    fresh = s.head.copy()
    fresh[1:] |= s.name[1:] != s.name[:-1]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(s.name)) - 1
    length = (last - first + 1).astype(np.uint64)
    name = np.where(length > 1, mixed(s.name[first] * _RUN + length), s.name[first])
    low = np.where(s.head[first], s.start[first] - 1, s.low[first - 1])
    after, alone = s.follows(last)
    return s.pick(first, name, low, np.where(alone, s.ends()[last] + 1, s.high[after]))


def sides(names: np.ndarray, number: int) -> np.ndarray:
    return mixed(names + np.uint64((number + 1) * _SECOND & 0xFFFFFFFFFFFFFFFF))


def name_pairs(s: Symbols, number: int, bit: int) -> Symbols:
    """One symbol for each neighbouring left and right one of round ``number``. A pair is
    fixed by its parts; a left symbol that stays also by the next one, a right symbol by the
    one before."""
    if not len(s.name):
        return s
    right = (sides(s.name, number) >> np.uint64(bit) & np.uint64(1)).astype(bool)
    at = np.arange(len(s.name))
    after, alone = s.follows(at)
    pair = ~right & right[after] & ~alone
    name = s.name.copy()
    name[pair] = mixed(s.name[pair] * _PAIR + mixed(s.name[after[pair]]))
    high = np.where(alone, s.ends() + 1, s.high[after])
    high[right] = s.high[right]
    low = s.low.copy()
    low[1:][right[1:]] = s.low[:-1][right[1:]]
    edge = right & s.head
    low[edge] = s.start[edge] - 1
    second = np.zeros(len(s.name), bool)
    second[after[pair]] = True
    kept = np.flatnonzero(~second)
    return s.pick(kept, name[kept], low[kept], high[kept])


def pairs_by_side(s: Symbols, number: int) -> np.ndarray:
    """How many pairs each side bit would name in round ``number``."""
    if len(s.name) < 2:
        return np.zeros(SIDES, np.int64)
    hashed = sides(s.name, number)
    would = ~hashed[:-1] & hashed[1:]
    would[s.head[1:]] = 0
    return np.array([np.count_nonzero(would >> np.uint64(b) & np.uint64(1))
                     for b in range(SIDES)], np.int64)


def _gains(s: Symbols, number: int) -> pa.Array:
    return pa.array([pairs_by_side(s, number)], pa.list_(pa.int64()))


def _packed(chunk: int, s: Symbols, number: int) -> pa.RecordBatch:
    """A row of ``SYMBOLS``, with what each side would bring in round ``number``."""

    def near(distance):
        return _pack(np.minimum(distance, _FAR).astype(np.uint16))

    return pa.RecordBatch.from_pydict({
        "chunk": pa.array([chunk], pa.int64()), "names": [_pack(s.name)],
        "lengths": [_pack(np.diff(s.start, append=s.total).astype(np.int32))],
        "before": [near(s.start - s.low)], "after": [near(s.high - s.start)],
        "heads": [_pack(s.head)], "gains": _gains(s, number)})


def _unpacked(row: dict) -> Symbols:
    length = _unpack(row["lengths"], np.int32)
    start = np.cumsum(length, dtype=np.int32) - length
    return Symbols(
        _unpack(row["names"], np.uint64), start,
        start - _unpack(row["before"], np.uint16).astype(np.int32),
        start + _unpack(row["after"], np.uint16).astype(np.int32),
        _unpack(row["heads"], np.bool_), int(length.sum()))


def _distinct(hashes: np.ndarray):
    """The distinct values, where each stands first, and the place of every value among them."""
    codes, found = pd.factorize(hashes)
    first = np.empty(len(found), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return found, first, codes


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of whole documents: their ids and word counts, the distinct words between
    spaces, and the words as numbers of those."""
    number = 0
    for batch in batches:
        column = column_of(batch, "text")
        ids, tasks = column_of(batch, "doc_id"), column_of(batch, "task")
        for chunk in blocks(column, CHUNK_BYTES):
            hashes, counts, starts, ends, done = [], [], [], [], 0
            for block in blocks(column.slice(chunk.first, len(chunk))):
                first, last, bounds = block.words(VISIBLE)
                hashes.append(word_hashes(block.data, first, last))
                counts.append(np.diff(bounds))
                starts.append(first + done)
                ends.append(last + done)
                done += len(block.data)
            counts = np.concatenate(counts)
            found, first, codes = _distinct(np.concatenate(hashes))
            starts, ends = np.concatenate(starts)[first], np.concatenate(ends)[first]
            data = chunk.data.tobytes()
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([(tasks[0].as_py() << 32) + number], pa.int64()),
                "ids": pa.array([ids.slice(chunk.first, len(chunk))], pa.list_(pa.int64())),
                "counts": [_pack(counts.astype(np.int32))],
                "vocabulary": [_pack(np.frombuffer(b" ".join(
                    data[a:b] for a, b in zip(starts, ends, strict=True)), np.uint8))],
                "codes": [_pack(codes.astype(np.int32))],
                "gains": _gains(word_symbols(found[codes], counts), 0)})
            number += 1


class Words:
    """The words of a chunk, as names."""

    def __init__(self, row: dict):
        self.counts = _unpack(row["counts"], np.int32).astype(np.int64)
        self.codes = _unpack(row["codes"], np.int32)
        self.joined = _unpack(row["vocabulary"], np.uint8)
        gaps = np.flatnonzero(self.joined == ord(" "))
        hashes = word_hashes(self.joined, np.append(0, gaps + 1), np.append(
            gaps, len(self.joined))) if len(self.codes) else np.zeros(0, np.uint64)
        self.names = hashes[self.codes]

    def vocabulary(self) -> np.ndarray:
        words = self.joined.tobytes().split(b" ")
        out = np.empty(len(words), object)
        out[:] = words
        return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _shortened(s: Symbols, number: int, bit: int) -> Symbols:
    return name_pairs(name_runs(s), number, bit)


def name_rounds(texts: DataFrame, rounds: int, size: int) -> DataFrame:
    """Shorten all sequences in ``rounds`` Spark rounds; the reads of each chunk, written."""

    def round_of(number: int, bit: int):
        last = number == rounds - 1

        def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                if number:
                    s = _unpacked(row)
                else:
                    words = Words(row)
                    s = word_symbols(words.names, words.counts)
                s = name_pairs(name_runs(s), number, bit)
                yield _reads_row(row["chunk"], s, size) if last else _packed(
                    row["chunk"], s, number + 1)

        return shorten

    table = texts.drop("ids")
    for number in range(rounds):
        gains = table.select(F.posexplode("gains").alias("bit", "pairs")).groupBy("bit").agg(
            F.sum("pairs").alias("pairs")).orderBy(F.desc("pairs"), "bit").first()
        shorter = written(
            table.drop("gains").mapInArrow(
                round_of(number, gains.bit if gains else 0),
                READS if number == rounds - 1 else SYMBOLS + GAINS),
            f"recompression-{number + 1}", compression="none")
        if number:
            dropped(table)
        table = shorter
    return table


def window_starts(s: Symbols, size: int) -> np.ndarray:
    """The words at which a window of their document starts."""
    first = s.start[s.head]
    length = np.diff(first, append=s.total)
    left = np.repeat(np.cumsum(length), length) - np.arange(s.total)
    return np.flatnonzero(left >= size)


def anchors(s: Symbols, starts: np.ndarray, size: int) -> np.ndarray:
    """For each window start the longest symbol among those whose context lies in the
    window (of equals the one of least hash, then the first), or -1."""
    if not len(s.name):
        return np.full(len(starts), -1)
    # Symbols before ``first`` begin too early, those from ``last`` on end too late.
    first = np.cumsum(np.bincount(s.low + 1, minlength=s.total + 1))[starts]
    ends = np.minimum(s.high, s.total + 1)
    last = np.cumsum(np.bincount(ends, minlength=s.total + 2))[starts + size]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    first, last = first[fresh], last[fresh]
    count = last - first
    length = np.minimum(s.ends() - s.start, 255).astype(np.uint64)
    rank = (mixed(s.name ^ _RUN) >> np.uint64(8)) | ((np.uint64(255) - length) << np.uint64(56))
    best = np.where(count > 0, first, -1)
    found = np.flatnonzero(count > 1)
    for step in range(1, int(count.max(initial=0))):
        found = found[count[found] > step]
        other = first[found] + step
        better = rank[other] < rank[best[found]]
        best[found[better]] = other[better]
    return best[np.cumsum(fresh) - 1]


class Reads(NamedTuple):
    """Neighbouring windows with one anchor: its name, hash of all their words, first and
    last window start. The hash is even; its low bit is for ``_entries``."""

    anchor: np.ndarray
    hashed: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _reads_row(chunk: int, s: Symbols, size: int) -> pa.RecordBatch:
    starts = window_starts(s, size)
    symbol = anchors(s, starts, size)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (symbol[1:] != symbol[:-1]) | (symbol[1:] < 0) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(fresh)
    first = starts[heads]
    last = starts[np.append(heads[1:], len(starts)) - 1] if len(heads) else first
    owned = symbol[heads] < 0
    return pa.RecordBatch.from_pydict({
        "chunk": pa.array([chunk], pa.int64()),
        "anchors": [_pack(s.name[symbol[heads][~owned]])], "owned": [_pack(owned)],
        "firsts": [_pack(np.diff(first, prepend=0).astype(np.int32))],
        "spans": [_pack((last - first).astype(np.int32))]})


def reads(words: Words, row: dict, size: int) -> Reads:
    """The reads of a chunk from its row of ``READS``. A window without an anchor has a hash
    of its own in its place."""
    first = np.cumsum(_unpack(row["firsts"], np.int32), dtype=np.int64)
    last = first + _unpack(row["spans"], np.int32)
    owned = _unpack(row["owned"], np.bool_)
    one, = stretch_sums(words.names, first, last + size, kinds=1)
    anchor = np.empty(len(first), np.uint64)
    anchor[~owned] = _unpack(row["anchors"], np.uint64)
    anchor[owned] = stretch_sums(words.names, first[owned], last[owned] + size)[1]
    return Reads(anchor, _value(one), first, last)


def _value(hashed: np.ndarray) -> np.ndarray:
    return (hashed | np.uint64(2)) & ~np.uint64(1)


def _groups(keys: np.ndarray, values: np.ndarray, pairs: bool):
    """Order of the entries by key and value, and where in it a new key begins (with
    ``pairs``: a new key or value)."""
    order = np.lexsort((values, keys))
    key, value = keys[order], values[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    if pairs:
        fresh[1:] |= value[1:] != value[:-1]
    return order, fresh


def _entries(keys: np.ndarray, values: np.ndarray, parts: int, pairs: bool = False):
    """Distinct keys in order of part, each with its value if it has only one (else
    ``_MANY``) and the low bit set if it occurs more than once; their parts; and for each
    given key its place among them. With ``pairs``, distinct keys and values."""
    order, fresh = _groups(keys, values, pairs)
    key, value = keys[order], values[order]
    heads = np.flatnonzero(fresh)
    lasts = np.append(heads[1:], len(key)) - 1 if len(heads) else heads
    only = np.where(value[heads] == value[lasts], value[heads], _MANY)
    only |= (lasts > heads).astype(np.uint64)
    distinct = key[heads]
    part = (mixed(distinct) % np.uint64(parts)).astype(np.int64)
    by_part = np.argsort(part, kind="stable")
    place = np.empty(len(heads), np.int64)
    place[by_part] = np.arange(len(heads))
    number = np.empty(len(key), np.int64)
    number[order] = place[np.cumsum(fresh) - 1]
    return distinct[by_part], only[by_part], part[by_part], number


SENT = "chunk long, part int, keys binary, only binary"


def _sent(chunk: int, keys: np.ndarray, only: np.ndarray, part: np.ndarray) -> pa.Table:
    names, heads = np.unique(part, return_index=True)
    cuts = list(zip(heads, np.append(heads[1:], len(part))[:len(heads)], strict=True))
    return pa.table({
        "chunk": pa.array([chunk] * len(cuts), pa.int64()), "part": pa.array(names, pa.int32()),
        "keys": pa.array([keys[a:b].tobytes() for a, b in cuts], pa.binary()),
        "only": pa.array([only[a:b].tobytes() for a, b in cuts], pa.binary())})


def _judged(sent: DataFrame, pairs: bool = False) -> DataFrame:
    """For each entry of each chunk: 0 if its key occurs once in the corpus, 1 if all its
    occurrences have one value, 2 if their values differ. With ``pairs`` a key counts
    together with its value."""

    def judge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
        only = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("only").to_pylist()])
        value = only & ~np.uint64(1)
        order, fresh = _groups(np.concatenate(keys), value, pairs)
        heads = np.flatnonzero(fresh)
        total = np.add.reduceat(1 + (only[order] & np.uint64(1)).astype(np.int64), heads)
        value = value[order]
        lasts = np.append(heads[1:], len(value)) - 1
        several = (value[heads] != value[lasts]) | (value[heads] == _MANY)
        code = np.empty(len(order), np.uint8)
        code[order] = np.where(several, 2, total > 1).astype(np.uint8)[np.cumsum(fresh) - 1]
        cuts = np.cumsum([0, *(len(k) for k in keys)])
        return pa.table({
            "chunk": table.column("chunk"), "part": table.column("part"),
            "codes": pa.array([code[a:b].tobytes() for a, b in zip(
                cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    return sent.groupBy("part").applyInArrow(judge, "chunk long, part int, codes binary")


def _in_parts(replies: list[dict], part: np.ndarray) -> np.ndarray:
    codes = np.zeros(len(part), np.uint8)
    for row in replies:
        codes[slice(*np.searchsorted(part, [row["part"], row["part"] + 1]))] = np.frombuffer(
            row["codes"], np.uint8)
    return codes


def _spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The places ``first[i]`` to ``last[i]`` of all i, one after another."""
    lengths = last - first + 1
    heads = np.cumsum(lengths) - lengths
    return np.repeat(first - heads, lengths) + np.arange(int(lengths.sum()))


def _compared(words: Words, found: Reads, code: np.ndarray, size: int, parts: int):
    """Windows of reads that differ under one anchor, as entries."""
    starts = _spread(found.first[code == 2], found.last[code == 2])
    one, two = stretch_sums(words.names, starts, starts + size)
    return starts, _entries(two, _value(one), parts, pairs=True)


def remove_repeats(docs: DataFrame, size: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (the remaining words joined by one
    space) of every row.

    Words are runs of other than ASCII white space, unchanged. A word goes if a window of
    ``size`` words that covers it has a word sequence that also starts elsewhere, be it in
    the same document; all copies go. Windows are judged on the input. Null texts count as
    empty, empty and short texts stay as they are, rows that repeat (also with their id)
    repeat each other's words, a null id stays null. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.spark_partition_id().cast("long").alias("task"))
    texts = written(rows.mapInArrow(_chunks, TEXTS + GAINS), "recompression-texts",
                    compression="none")
    found = name_rounds(texts, max(rounds, 1), size)
    sent = found.select(F.sum(F.octet_length("anchors"))).first()[0] or 0
    parts = max(1, math.ceil(2 * sent / CHUNK_BYTES))
    chunks = texts.drop("gains").unionByName(found, allowMissingColumns=True).groupBy("chunk")

    def both(table: pa.Table) -> tuple[dict, Words, Reads]:
        rows = table.to_pylist()
        row = next(r for r in rows if r["codes"] is not None)
        words = Words(row)
        return row, words, reads(words, next(r for r in rows if r["firsts"] is not None), size)

    def send_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, _, own = both(table)
        keys, only, part, _ = _entries(own.anchor, own.hashed, parts)
        return _sent(key[0].as_py(), keys, only, part)

    def judged_reads(table: pa.Table, replies: list[dict]):
        row, words, own = both(table)
        _, _, part, number = _entries(own.anchor, own.hashed, parts)
        return row, words, own, _in_parts(replies, part)[number]

    def send_windows(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        _, words, own, code = judged_reads(table, replies.to_pylist())
        _, (keys, only, part, _) = _compared(words, own, code, size, parts)
        return _sent(key[0].as_py(), keys, only, part)

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        replies = replies.to_pylist()
        row, words, own, code = judged_reads(table, [r for r in replies if r["step"] == 1])
        starts, (_, _, part, number) = _compared(words, own, code, size, parts)
        again = _in_parts([r for r in replies if r["step"] == 2], part)[number] > 0
        repeated = np.concatenate([_spread(own.first[code == 1], own.last[code == 1]),
                                   starts[again]])
        change = np.bincount(repeated, minlength=len(words.codes) + 1)
        change -= np.bincount(repeated + size, minlength=len(words.codes) + 1)
        gone = np.cumsum(change[:-1]) > 0
        total = np.append(0, np.cumsum(gone))
        last = np.cumsum(words.counts)
        first = last - words.counts
        vocabulary = words.vocabulary()
        kept = [b" ".join(vocabulary[words.codes[a:b][~gone[a:b]]].tolist())
                for a, b in zip(first, last, strict=True)]
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), "n_words": words.counts,
            "n_removed": pa.array(total[last] - total[first], pa.int64()),
            "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    codes = _judged(chunks.applyInArrow(send_anchors, SENT))
    windows = _judged(chunks.cogroup(codes.groupBy("chunk")).applyInArrow(send_windows, SENT),
                      pairs=True)
    replies = codes.withColumn("step", F.lit(1)).unionByName(windows.withColumn("step", F.lit(2)))
    return chunks.cogroup(replies.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_words long, n_removed long, kept string")
