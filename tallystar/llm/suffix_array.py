"""Repeated passages by column-wise construction of a multi-document suffix array.

A byte is removed if a string of 50 bytes that covers it also starts in a document with a
smaller id. Strings of 50 bytes are compared by sorting: many short texts ("reads") are
indexed together by inserting one symbol of each per round, last symbols first. A round
reads the Burrows-Wheeler transform and the common prefixes of the collection so far from
sequential files, finds by rank where each longer suffix goes, and writes both files anew.
Afterwards suffixes that share 50 bytes stand next to each other.

Indexing the whole corpus as one collection would take as many rounds as the longest
document has bytes, each over the whole index. So the corpus is first cut where equal
strings must meet: of the 16-byte grams in a string of 50 the one with the least hash is
its anchor, and equal strings have equal anchors. Neighbouring strings with one anchor
make a read. Reads whose anchor is in one document only are dropped; the others meet by
anchor, equal ones once. Anchors found in very many documents are replaced by the strings
themselves, so that no anchor brings an unbounded group into one task.

Documents are dealt into chunks of bounded size. A chunk sends its anchors, gets back
which are shared, sends those reads, and gets back the least id for each string.
"""
from __future__ import annotations

import hashlib
import math
import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.blocks import blocks, column_of, mixed, stretch_hashes, word_hashes
from tallystar.llm.shared import once

WINDOW = 50
GRAM = 16
CHUNK_BYTES = 8 << 20
BATCH_READS = 4000
HOT_DOCUMENTS = 4096
NO_ID = np.iinfo(np.int64).max

_COUNT = np.uint64(0xFFFF)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place on (zeros past the end)."""
    key = data.astype(np.uint64)
    for step in (1, 2, 4):
        key[:-step] |= key[step:] << np.uint64(8 * step)
    key *= np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    ahead = np.zeros_like(key)
    ahead[:-8] = key[8:]
    key += ahead * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed(key)


def anchored_runs(data: np.ndarray, offsets: np.ndarray):
    """Runs of neighbouring strings with the same anchor: anchor hash, first and last place
    at which a string of the run starts. Runs never leave a document."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none.astype(np.uint64), none, none
    hashes = _gram_hashes(data)
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(data), dtype=np.uint64)
    grams, size = WINDOW - GRAM + 1, 1
    while size < grams:
        step = min(size, grams - size)
        least[:-step] = np.minimum(least[:-step], least[step:])
        size += step
    counts = np.maximum(np.diff(offsets) - WINDOW + 1, 0)
    starts = np.repeat(offsets[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    if not len(starts):
        return none.astype(np.uint64), none, none
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    heads = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    lasts = np.append(heads[1:], len(starts)) - 1
    return hashes[anchor[heads]], starts[heads], starts[lasts]


class Chunk:
    """The documents of one chunk end to end, with their anchored runs."""

    def __init__(self, table: pa.Table):
        column = column_of(table, "text")
        ids = column_of(table, "doc_id")
        self.ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        cut = list(blocks(column))
        sizes = [len(block.data) for block in cut]
        heads = np.cumsum([0, *sizes])
        self.data = np.concatenate([b.data for b in cut]) if cut else np.zeros(0, np.uint8)
        self.offsets = np.concatenate(
            [[0], *(b.offsets[1:] + h for b, h in zip(cut, heads, strict=False))]).astype(np.int64)
        found = [anchored_runs(b.data, b.offsets) for b in cut]
        self.anchor = np.concatenate([f[0] for f in found]) if cut else np.zeros(0, np.uint64)
        self.first, self.last = (
            np.concatenate([f[k] + h for f, h in zip(found, heads, strict=False)])
            if cut else np.zeros(0, np.int64) for k in (1, 2))
        self.hashes = np.concatenate([
            stretch_hashes(b.data, f[1], f[2] + WINDOW) for b, f in zip(cut, found, strict=True)
        ]) if cut else np.zeros(0, np.uint64)
        self.anchor &= ~_COUNT
        self.owner = np.searchsorted(self.offsets, self.first, "right") - 1

    def anchors(self, parts: int):
        """Distinct anchors by part, with the number of documents in their low bits; their
        parts; and the place of each run's anchor among them."""
        if not len(self.anchor):
            return self.anchor, np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.argsort(self.anchor, kind="stable")  # documents stay in order
        key, owner = self.anchor[order], self.owner[order]
        new_key = np.append(True, key[1:] != key[:-1])
        heads = np.flatnonzero(new_key)
        fresh = new_key | np.append(True, owner[1:] != owner[:-1])
        documents = np.add.reduceat(fresh.astype(np.int64), heads)
        distinct = key[heads]
        part = (mixed(distinct) % np.uint64(parts)).astype(np.int64)
        by_part = np.argsort(part, kind="stable")
        place = np.empty(len(heads), np.int64)
        place[by_part] = np.arange(len(heads))
        number = np.empty(len(order), np.int64)
        number[order] = place[np.cumsum(new_key) - 1]
        counted = distinct | np.minimum(documents, 0xFFFF).astype(np.uint64)
        return counted[by_part], part[by_part], number

    def reads(self, parts: int, replies: pa.Table):
        """Distinct reads of shared anchors, by part; and for every occurrence its read.

        ``replies`` has what each part knows about the anchors sent to it.
        """
        _, part, anchor_number = self.anchors(parts)
        codes = np.zeros(len(part), np.uint8)
        for p, code in zip(replies.column("part").to_pylist(), replies.column("codes").to_pylist(),
                           strict=True):
            own = slice(*np.searchsorted(part, [p, p + 1]))
            codes[own] = np.frombuffer(code, np.uint8)
        code = codes[anchor_number]
        plain, hot = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
        counts = (self.last - self.first + 1)[hot]
        each = np.repeat(hot, counts)
        start = self.first[each] + np.arange(len(each)) - np.repeat(
            np.cumsum(counts) - counts, counts)
        starts = np.concatenate([self.first[plain], start])
        ends = np.concatenate([self.last[plain], start]) + WINDOW
        owner = np.concatenate([self.owner[plain], self.owner[each]])
        hashes = np.concatenate([self.hashes[plain], *(
            word_hashes(self.data, start[i:i + 20000], start[i:i + 20000] + WINDOW)
            for i in range(0, len(start), 20000))])
        key = np.concatenate([self.anchor[plain], hashes[len(plain):] & ~_COUNT])
        both = mixed(hashes ^ mixed(key))  # equal reads have equal anchors
        order = np.argsort(both, kind="stable")
        ranked = both[order]
        heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(order) else order
        least = (np.minimum.reduceat(self.ids[owner[order]], heads) if len(heads)
                 else np.zeros(0, np.int64))
        pick = order[heads]
        part = (mixed(key[pick]) % np.uint64(parts)).astype(np.int64)
        by_part = np.argsort(part, kind="stable")
        place = np.empty(len(heads), np.int64)
        place[by_part] = np.arange(len(heads))
        number = np.empty(len(order), np.int64)
        number[order] = np.repeat(place, np.diff(np.append(heads, len(order))))
        pick, part, least = pick[by_part], part[by_part], least[by_part]
        return (part, key[pick], hashes[pick], least, starts[pick], ends[pick],
                starts, owner, number)


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``starts[i]`` to ``starts[i] + lengths[i] - 1`` of all i, one after another."""
    heads = np.cumsum(lengths) - lengths
    return np.repeat(starts - heads, lengths) + np.arange(int(lengths.sum()))


class ColumnIndex:
    """Burrows-Wheeler transform and common prefixes of a collection of reads.

    Symbol 0 ends a read; other symbols are bytes plus one (no byte of UTF-8 is 255). Row
    i of the first ``len(lengths)`` is the empty suffix of read i. Both columns lie in
    mapped files of ``folder``: a round goes through the old ones from front to back and
    fills the new ones likewise.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, folder: str):
        self.count = len(lengths)
        room = self.count + int(lengths.sum())
        self.files = [
            [np.memmap(os.path.join(folder, f"{name}{k}"), np.uint8, "w+", shape=room)
             for name in ("transform", "prefixes")] for k in (0, 1)]
        self.size = self.count
        ends = starts + lengths
        self.files[0][0][:self.size] = data[ends - 1] + np.uint8(1)
        rows = np.arange(self.count)
        for done in range(1, int(lengths.max(initial=0)) + 1):
            active = np.flatnonzero(lengths >= done)
            more = lengths[active] > done
            following = np.zeros(len(active), np.uint8)
            following[more] = data[ends[active[more]] - done - 1] + np.uint8(1)
            rows[active] = self._insert(rows[active], following)

    def _columns(self) -> tuple[np.ndarray, np.ndarray]:
        return self.files[0][0][:self.size], self.files[0][1][:self.size]

    def _ranked(self, transform: np.ndarray):
        """Rows by the symbol before them, and where each row's longer suffix goes."""
        order = np.argsort(transform, kind="stable")
        ended = int(np.count_nonzero(transform == 0))
        goes = np.empty(len(transform), np.int64)
        goes[order] = np.arange(self.count - ended, self.count - ended + len(transform))
        return order, goes, ended

    def _insert(self, rows: np.ndarray, following: np.ndarray) -> np.ndarray:
        """Put in the suffixes one symbol longer than those at ``rows``."""
        transform, prefixes = self._columns()
        order, goes, ended = self._ranked(transform)
        at = goes[rows]
        rank = at - self.count + ended
        least = _range_minimum(prefixes)
        symbol = transform[rows]
        before = np.maximum(rank - 1, 0)
        after = np.minimum(rank + 1, len(order) - 1)
        has_before = (rank > 0) & (transform[order[before]] == symbol)
        has_after = (rank + 1 < len(order)) & (transform[order[after]] == symbol)
        up = np.zeros(len(rows), np.uint8)
        up[has_before] = 1 + least(order[before][has_before] + 1, rows[has_before] + 1)
        down = np.zeros(len(rows), np.uint8)
        down[has_after] = 1 + least(rows[has_after] + 1, order[after][has_after] + 1)
        self.size += len(rows)
        self.files.reverse()
        new_transform, new_prefixes = self._columns()
        old = np.ones(self.size, bool)
        old[at] = False
        new_transform[old], new_transform[at] = transform, following
        new_prefixes[old] = prefixes
        inside = at + 1 < self.size
        new_prefixes[at[inside] + 1] = down[inside]
        new_prefixes[at] = up
        return at

    def suffixes(self, longest: int):
        """Rows of the suffixes of each length (from the ends of the reads leftwards)."""
        transform, _ = self._columns()
        _, goes, _ = self._ranked(transform)
        rows = np.arange(self.count)
        for _ in range(longest):
            rows = np.where(transform[rows] > 0, goes[rows], rows)
            yield rows

    def classes(self) -> np.ndarray:
        """Number of the group of rows that agree in their first ``WINDOW`` symbols."""
        return np.cumsum(np.asarray(self._columns()[1]) < WINDOW)


def _range_minimum(values: np.ndarray):
    """Minimum of ``values[low:high]`` for arrays of non-empty ranges, by doubling."""
    width, depth = len(values), max(1, len(values).bit_length())
    flat = np.empty((depth, width), values.dtype)
    flat[0] = values
    for k in range(1, depth):
        step = 1 << (k - 1)
        np.minimum(flat[k - 1, :-step], flat[k - 1, step:], out=flat[k, :-step])

    def least(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        return np.minimum(flat[level, low], flat[level, high - (1 << level)])

    return least


def least_ids(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray):
    """For each string of each read (by read, then start) the least id of the reads that
    have it anywhere."""
    counts = lengths - WINDOW + 1
    heads = np.cumsum(counts) - counts
    group = np.empty(int(counts.sum()), np.int64)
    with tempfile.TemporaryDirectory() as folder:
        index = ColumnIndex(data, starts, lengths, folder)
        classes = index.classes()
        for size, rows in enumerate(index.suffixes(int(lengths.max(initial=0))), 1):
            if size >= WINDOW:
                whole = np.flatnonzero(lengths >= size)
                group[heads[whole] + lengths[whole] - size] = classes[rows[whole]]
    best = np.full(int(classes[-1]) + 1 if len(classes) else 0, NO_ID)
    np.minimum.at(best, group, np.repeat(ids, counts))
    return best[group]


def _changes(values: np.ndarray, counts: np.ndarray):
    """Run-length form of each read's ids: how many runs each has, their lengths and ids."""
    owner = np.repeat(np.arange(len(counts)), counts)
    heads = np.flatnonzero(np.append(
        True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1]))) if len(values) else owner
    return (np.bincount(owner[heads], minlength=len(counts)),
            np.diff(np.append(heads, len(values))), values[heads])


def _shared_anchors(sent: DataFrame) -> DataFrame:
    """For each chunk and part: 0 for an anchor of one document, 1 for a shared one, 2 for
    one of very many documents."""

    def judge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, np.uint64) for x in table.column("anchors").to_pylist()]
        every = np.concatenate(own)
        found, place = np.unique(every & ~_COUNT, return_inverse=True)
        total = np.bincount(place, (every & _COUNT).astype(float), len(found))
        code = ((total > 1).astype(np.uint8) + (total > HOT_DOCUMENTS))[place].astype(np.uint8)
        cuts = np.cumsum([0, *(len(x) for x in own)])
        return pa.table({
            "chunk": table.column("chunk"), "part": table.column("part"),
            "codes": pa.array([code[a:b].tobytes() for a, b in zip(
                cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    return sent.groupBy("part").applyInArrow(judge, "chunk long, part int, codes binary")


def _matched(sent: DataFrame) -> DataFrame:
    """For each chunk and part: the least ids of the strings of the reads sent."""

    def match(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, hashes, ids, lengths, texts = ([] for _ in range(5))
        for row in table.to_pylist():
            keys.append(np.frombuffer(row["keys"], np.uint64))
            hashes.append(np.frombuffer(row["hashes"], np.uint64))
            ids.append(np.frombuffer(row["ids"], np.int64))
            lengths.append(np.frombuffer(row["lengths"], np.uint8).astype(np.int64))
            texts.append(np.frombuffer(pa.decompress(
                row["bytes"], decompressed_size=int(lengths[-1].sum()), codec="zstd",
                asbytes=True), np.uint8))
        cuts = np.cumsum([0, *(len(x) for x in keys)])
        key, hashed, own, length, text = map(np.concatenate, (keys, hashes, ids, lengths, texts))
        start = np.cumsum(length) - length
        order = np.lexsort((hashed, key))
        k, h = key[order], hashed[order]
        heads = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1])))
        number = np.empty(len(order), np.int64)
        number[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
        least = np.minimum.reduceat(own[order], heads)
        pick = order[heads]
        key, start, length = key[pick], start[pick], length[pick]
        groups = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(groups, len(key)))
        several = np.flatnonzero(np.repeat(sizes > 1, sizes))
        edges = np.flatnonzero(np.append(True, key[several][1:] != key[several][:-1]))
        edges = np.append(edges, len(several))
        changes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at = 0
        while at < len(several):  # whole anchors
            stop = int(edges[np.searchsorted(edges, min(at + BATCH_READS, len(several)))])
            batch = several[at:stop]
            found = least_ids(text[_spread(start[batch], length[batch])],
                              np.cumsum(length[batch]) - length[batch], length[batch],
                              least[batch])
            for column, values in zip(
                    changes, _changes(found, length[batch] - WINDOW + 1), strict=True):
                column.append(values)
            at = stop
        n, run_lengths, run_ids = map(np.concatenate, changes)
        counts = np.ones(len(key), np.int64)
        counts[several] = n
        run_heads = np.cumsum(counts) - counts
        spans, found_ids = np.repeat(length - WINDOW + 1, counts), np.repeat(least, counts)
        place = _spread(run_heads[several], n)
        spans[place], found_ids[place] = run_lengths, run_ids
        rows = []
        for row, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            mine = number[a:b]
            place = _spread(run_heads[mine], counts[mine])
            rows.append({
                "chunk": table.column("chunk")[row].as_py(),
                "part": table.column("part")[row].as_py(),
                "counts": counts[mine].astype(np.uint8).tobytes(),
                "spans": spans[place].astype(np.uint8).tobytes(),
                "ids": found_ids[place].tobytes()})
        return pa.Table.from_pylist(rows, pa.schema(
            [("chunk", pa.int64()), ("part", pa.int32()), ("counts", pa.binary()),
             ("spans", pa.binary()), ("ids", pa.binary())]))

    return sent.groupBy("part").applyInArrow(
        match, "chunk long, part int, counts binary, spans binary, ids binary")


def _by_part(part: np.ndarray, parts: int):
    cuts = np.searchsorted(part, np.arange(parts + 1))
    return [(p, slice(cuts[p], cuts[p + 1])) for p in range(parts) if cuts[p] < cuts[p + 1]]


def _covered(chunk: Chunk, parts: int, codes: pa.Table, replies: pa.Table) -> np.ndarray:
    """Which bytes of a chunk are covered by a string of a document with a smaller id."""
    part, _, _, _, starts, ends, all_starts, owner, number = chunk.reads(parts, codes)
    lengths = ends - starts - WINDOW + 1
    counts = np.zeros(len(part), np.int64)
    spans, ids = [], []
    ordered = sorted(zip(*(replies.column(c).to_pylist() for c in (
        "part", "counts", "spans", "ids")), strict=True), key=lambda row: row[0])
    for p, n, span, known in ordered:
        counts[slice(*np.searchsorted(part, [p, p + 1]))] = np.frombuffer(n, np.uint8)
        spans.append(np.frombuffer(span, np.uint8))
        ids.append(np.frombuffer(known, np.int64))
    change = np.zeros(len(chunk.data) + 1, np.int32)
    if ordered and len(number):
        spans, ids = np.concatenate(spans).astype(np.int64), np.concatenate(ids)
        run_heads = np.cumsum(counts) - counts
        offset = np.cumsum(spans) - spans
        offset -= np.repeat(np.cumsum(lengths) - lengths, counts)  # within its read
        times = counts[number]
        run = _spread(run_heads[number], times)
        each = np.repeat(np.arange(len(number)), times)
        older = ids[run] < chunk.ids[owner[each]]
        run, each = run[older], each[older]
        begin = all_starts[each] + offset[run]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + spans[run] - 1 + WINDOW, -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def _running(flags: np.ndarray) -> np.ndarray:
    """How many are set before each place; a chunk is far below 2 GB."""
    total = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=total[1:])
    return total


def remove_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (runs removed) and ``kept_sha256`` of
    every row, and with ``texts`` the remaining bytes as ``kept``.

    Strings are judged on the input, whole texts as UTF-8, null as empty. Rows with the
    same id never remove each other's bytes. Rows without an id count as coming after all
    others and remove nothing. Texts below 50 bytes stay. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Rows equal in id and text have the same result and add nothing to each other's.
    rows, again = once(rows, {"doc_id": F.col("doc_id"), "one": F.xxhash64("text"),
                              "two": F.xxhash64("text", F.lit(1))})
    rows = rows.drop("times")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / CHUNK_BYTES))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts))).repartition(
        max(parts, 2), "chunk")

    def send_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        counted, part, _ = Chunk(table).anchors(parts)
        cut = _by_part(part, parts)
        return pa.table({
            "chunk": pa.array([key[0].as_py()] * len(cut), pa.int64()),
            "part": pa.array([p for p, _ in cut], pa.int32()),
            "anchors": pa.array([counted[s].tobytes() for _, s in cut], pa.binary())})

    def send_reads(key, ours: pa.Table, codes: pa.Table) -> pa.Table:
        chunk = Chunk(ours)
        part, keys, hashes, least, starts, ends, *_ = chunk.reads(parts, codes)
        cut = _by_part(part, parts)
        lengths = ends - starts
        return pa.table({
            "chunk": pa.array([key[0].as_py()] * len(cut), pa.int64()),
            "part": pa.array([p for p, _ in cut], pa.int32()),
            "keys": pa.array([keys[s].tobytes() for _, s in cut], pa.binary()),
            "hashes": pa.array([hashes[s].tobytes() for _, s in cut], pa.binary()),
            "ids": pa.array([least[s].tobytes() for _, s in cut], pa.binary()),
            "lengths": pa.array([lengths[s].astype(np.uint8).tobytes() for _, s in cut],
                                pa.binary()),
            "bytes": pa.array([pa.compress(
                chunk.data[_spread(starts[s], lengths[s])].tobytes(), codec="zstd", asbytes=True)
                for _, s in cut], pa.binary())})

    def finish(key, ours: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = Chunk(ours)
        filled = replies.column("codes").is_valid()
        covered = _covered(chunk, parts, replies.filter(filled),
                           replies.filter(replies.column("counts").is_valid()))
        total = _running(covered)
        edge = covered.copy()
        edge[1:] &= ~covered[:-1]
        inner = chunk.offsets[:-1][np.diff(chunk.offsets) > 0]
        edge[inner] = covered[inner]
        spans = _running(edge)
        first, last = chunk.offsets[:-1], chunk.offsets[1:]
        kept = [chunk.data[a:b][~covered[a:b]].tobytes() for a, b in zip(first, last, strict=True)]
        out = {
            "doc_id": ours.column("doc_id"), "one": ours.column("one"), "two": ours.column("two"),
            "n_bytes": last - first,
            "n_removed": (total[last] - total[first]).astype(np.int64),
            "n_spans": (spans[last] - spans[first]).astype(np.int64),
            "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept]}
        return pa.table({**out, "kept": pa.array(kept, pa.binary())} if texts else out)

    sent = dealt.groupBy("chunk").applyInArrow(
        send_anchors, "chunk long, part int, anchors binary")
    codes = _shared_anchors(sent)
    reads = dealt.groupBy("chunk").cogroup(codes.groupBy("chunk")).applyInArrow(
        send_reads, "chunk long, part int, keys binary, hashes binary, ids binary, "
                    "lengths binary, bytes binary")
    replies = codes.unionByName(_matched(reads), allowMissingColumns=True)
    schema = ("doc_id long, one long, two long, n_bytes long, n_removed long, n_spans long, "
              "kept_sha256 string")
    done = dealt.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        finish, schema + (", kept binary" if texts else ""))
    return again(done).drop("one", "two")
