"""Text columns as flat byte arrays, so that numpy handles many documents at once.

Words are cut and hashed on the UTF-8 bytes: every separator is an ASCII byte, and no
byte of a longer code point is one, so byte-wise cutting equals cutting code points.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Small enough for the arrays over a block to stay in a core's cache.
BLOCK_BYTES = 1 << 17

# The ASCII white space that separates words.
WHITE_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

VISIBLE = np.ones(256, bool)
VISIBLE[list(WHITE_SPACE)] = False
ALPHANUMERIC = np.array([chr(i).isalnum() and i < 128 or i >= 128 for i in range(256)])
LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], np.uint8)

_RANDOM = np.random.RandomState(20240229)
_BYTE_VALUES = _RANDOM.randint(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2)
_BYTE_VALUES |= np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1 << 10, np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of SplitMix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def powers(count: int) -> np.ndarray:
    global _powers
    if len(_powers) < count or _powers[1] == 1:
        size = max(count, len(_powers))
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


_inverse = np.ones(1, np.uint64)


def _inverse_powers(count: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < count:
        steps = np.full(count, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
        steps[0] = 1
        _inverse = np.cumprod(steps)
    return _inverse


class Block:
    """Documents ``first`` to ``first + len(self)`` of a column, end to end.

    ``offsets[i]:offsets[i + 1]`` are the bytes of document i in ``data``. A null text
    counts as empty.
    """

    def __init__(self, first: int, offsets: np.ndarray, data: np.ndarray):
        self.first, self.offsets, self.data = first, offsets, data

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes of ``kind``, which never cross
        documents, and ``bounds``: words ``bounds[i]:bounds[i + 1]`` are document i's."""
        inside = kind[self.data]
        before = np.empty(len(inside) + 1, bool)
        before[0] = False
        before[1:] = inside
        before[self.offsets] = False
        starts = np.flatnonzero(inside & ~before[:-1])
        after = np.empty(len(inside) + 1, bool)
        after[:-1] = inside
        after[self.offsets] = False
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of whole documents of about ``limit`` bytes; a
    longer document is a block of its own."""
    if column.null_count:
        column = pc.fill_null(column, "")
    _, places, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if places is None or len(column) == 0:
        return
    offsets = np.frombuffer(places, width)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Block(first, offsets[first:last + 1] - offsets[first],
                    raw[offsets[first]:offsets[last]])
        first = last


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    heads = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
    letters = data[np.repeat(starts, lengths) + place]
    values = _BYTE_VALUES[letters] * powers(int(lengths.max()))[place]
    return mixed(np.add.reduceat(values, heads))


def stretch_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same kind of hash of stretches that overlap a lot: from running sums, so that a
    stretch costs no more for being long."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(len(data))[:len(data)], out=running[1:])
    return mixed((running[ends] - running[starts]) * _inverse_powers(len(data))[starts])


def stretch_sums(names: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: int = 2):
    """Up to two independent 64-bit hashes of each stretch of a sequence of names, from
    running sums: a stretch costs no more for being long."""
    every = []
    for salt in (0x8CB92BA72F3D8DD7, 0xC6A4A7935BD1E995)[:kinds]:
        running = np.zeros(len(names) + 1, np.uint64)
        np.cumsum(mixed(names ^ np.uint64(salt)) * powers(len(names))[:len(names)],
                  out=running[1:])
        inverse = _inverse_powers(max(len(names), 1))
        every.append(mixed((running[ends] - running[starts]) * inverse[starts]))
    return every


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int):
    """Hashes of each document's runs of ``size`` words, and the document of each.

    A document with fewer words has its whole sequence as one; without words, none.
    """
    counts = np.diff(bounds)
    weights = powers(size + 1)[1:size + 1]
    runs = np.maximum(counts - size + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < size))
    owner = np.repeat(np.arange(len(counts)), runs)
    place = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    place += np.repeat(bounds[:-1], runs)
    values = np.zeros(len(place), np.uint64)
    for k in range(size):
        values += words[place + k] * weights[k]
    if len(short):
        tails = [
            np.add.reduce(words[bounds[i]:bounds[i + 1]] * weights[:counts[i]])
            + np.uint64(counts[i]) for i in short
        ]
        values = np.concatenate([values, np.array(tails, np.uint64)])
        owner = np.concatenate([owner, short])
    return mixed(values), owner


def column_of(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    column = batch.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
