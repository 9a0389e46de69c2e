"""Fill-in-the-middle examples cut at unit boundaries with a wavelet matrix.

A text is a sequence of bytes, each of one of eight classes. A wavelet matrix stores the
three bits of the classes level by level, on each level with the bytes sorted by the bits
above, and a running count of ones. A rank query (how many bytes of a class stand before a
place) walks the three levels. Classes tell apart whether a blank or line break ends a word,
a mark a sentence, and which bytes only continue a code point, so that sums of ranks count
any kind of unit: lines are the line breaks of two classes, words the blanks and breaks that
end one. A cut after k units is the least place whose summed rank is k, found by bisection
for all texts of a block at once. A rank also gives the code points before a cut.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.blocks import BLOCK_BYTES, Block, VISIBLE, blocks, column_of

LETTER, CONTINUED, BLANK, WORD_BLANK, BREAK, WORD_BREAK, MARK, SENTENCE_MARK = range(8)
LEVELS = 3

# What ends a sentence, if white space or the end of the text follows.
SENTENCE_MARKS = b".!?"

# A unit ends with a byte of one of these classes, and with the text.
UNITS = {
    "line": (BREAK, WORD_BREAK),
    "word": (WORD_BLANK, WORD_BREAK),
    "sentence": (SENTENCE_MARK,),
}

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKERS = "<[PSM]>"


def byte_classes(block: Block) -> np.ndarray:
    """The class of every byte; what ends a word or sentence is judged within its text."""
    data = block.data
    kinds = np.zeros(256, np.uint8)
    kinds[0x80:0xC0] = CONTINUED
    kinds[~VISIBLE] = BLANK
    kinds[ord("\n")] = BREAK
    kinds[list(SENTENCE_MARKS)] = MARK
    out = kinds[data]
    visible = VISIBLE[data]
    first = np.zeros(len(data) + 1, bool)
    first[block.offsets] = True
    ends_word = ~visible[1:] & visible[:-1] & ~first[1:-1]
    out[1:][ends_word] += 1
    ends_sentence = out == MARK
    ends_sentence[:-1] &= ~visible[1:] | first[1:-1]
    out[ends_sentence] = SENTENCE_MARK
    return out


class WaveletMatrix:
    """Ranks over a sequence of values below ``2 ** LEVELS``."""

    def __init__(self, values: np.ndarray):
        self.ones, self.zeros = [], []
        for level in reversed(range(LEVELS)):
            bit = values >> level & 1
            count = np.zeros(len(bit) + 1, np.int64)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(bit) - int(count[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, value: int, places: np.ndarray) -> np.ndarray:
        """How often ``value`` stands before each of ``places``."""
        first = np.zeros_like(places)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            if value >> (LEVELS - 1 - level) & 1:
                first, places = zeros + ones[first], zeros + ones[places]
            else:
                first, places = first - ones[first], places - ones[places]
        return places - first


class Units:
    """Units of one kind in the texts of a block."""

    def __init__(self, block: Block, unit: str):
        self.matrix = WaveletMatrix(byte_classes(block))
        self.classes = UNITS[unit]
        self.first, self.last = block.offsets[:-1], block.offsets[1:]
        self.before = self.ends(self.first)
        self.ended = self.ends(self.last) - self.before
        # A last unit without its end counts too: bytes follow the last end.
        rest = self.after(self.ended) < self.last
        self.count = self.ended + rest

    def ends(self, places: np.ndarray) -> np.ndarray:
        """How many units end before each place: the ranks of all classes that end one."""
        return sum(self.matrix.rank(c, places) for c in self.classes)

    def after(self, number: np.ndarray) -> np.ndarray:
        """The place after the first ``number`` units of each text, by bisection: the least
        one before which that many end. The whole text if it has fewer ends."""
        low, high = self.first.copy(), self.last.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            enough = self.ends(middle) - self.before >= number
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low

    def code_points(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Code points from ``first`` to ``last``: bytes that do not continue one."""
        continued = self.matrix.rank(CONTINUED, last) - self.matrix.rank(CONTINUED, first)
        return last - first - continued


def _cut(table: pa.RecordBatch, block: Block, unit: str) -> pa.RecordBatch:
    units = Units(block, unit)
    n = units.count
    one, two = (column_of(table, c).to_numpy(zero_copy_only=False)[
        block.first:block.first + len(block)].astype(np.int64) for c in ("draw_one", "draw_two"))
    order = column_of(table, "order").to_pylist()[block.first:block.first + len(block)]
    a, b = np.sort([one % (n + 1), two % (n + 1)], axis=0)
    first, second = units.after(a), units.after(b)
    data = block.data.tobytes()
    forms, outputs = [], []
    for begin, p, q, end, wanted in zip(
            units.first, first, second, units.last, order, strict=True):
        text = data[begin:end]
        if wanted == "plain" or not text or any(
                m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
            forms.append("plain")
            outputs.append(text)
            continue
        forms.append(wanted)
        prefix = PREFIX.encode() + data[begin:p]
        suffix = SUFFIX.encode() + data[q:end]
        outputs.append((prefix + suffix if wanted == "psm" else suffix + prefix)
                       + MIDDLE.encode() + data[p:q])
    plain = np.array([f == "plain" for f in forms], bool)
    return pa.RecordBatch.from_pydict({
        "_row": column_of(table, "_row").slice(block.first, len(block)), "n": n, "form": forms,
        "prefix_chars": pa.array(units.code_points(units.first, first), mask=plain),
        "middle_chars": pa.array(units.code_points(first, second), mask=plain),
        "output": pa.array(outputs, pa.binary()).cast(pa.string())})


def draws(doc_id: Column, seed: str, rate: int, suffix_first: int) -> list[Column]:
    """Two numbers for the cuts and the order of the parts, drawn by hash from the id alone
    (a null id counts as empty): ``rate`` of a hundred texts are cut, ``suffix_first`` of a
    hundred of those as suffix, prefix, middle."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)

    def number(k):
        return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")

    order = (F.when(number(2) % 100 >= rate, "plain")
             .when(number(3) % 100 < suffix_first, "spm").otherwise("psm"))
    return [number(0).alias("draw_one"), number(1).alias("draw_two"), order.alias("order")]


def fill_in_middle(docs: DataFrame, unit: str = "line", seed: str = "7", rate: int = 100,
                   suffix_first: int = 50) -> DataFrame:
    """For every row ``doc_id``, ``n`` (units of its text), ``form``, ``prefix_chars`` and
    ``middle_chars`` (code points) and ``output``: the text with its middle moved to the end.

    The text is cut after two drawn numbers of units ("line", "word" or "sentence"; the last
    need not be ended). ``form`` is "psm", "spm" or "plain"; texts that are empty or hold a
    marker stay plain, with null sizes. Null texts count as empty, ids may be null or repeat:
    rows of one id draw alike. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").alias("_row"), "text",
                       *draws(F.col("doc_id"), seed, rate, suffix_first))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(column_of(batch, "text"), BLOCK_BYTES):
                yield _cut(batch, block, unit)

    id_type = rows.schema["_row"].dataType.simpleString()
    return rows.mapInArrow(
        cut, f"_row {id_type}, n long, form string, prefix_chars long, middle_chars long, "
             "output string").withColumnRenamed("_row", "doc_id")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    parts = F.split(output, _MARKERS)
    prefix, suffix = F.when(form == "psm", parts[1]).otherwise(parts[2]), F.when(
        form == "psm", parts[2]).otherwise(parts[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))
