"""Benchmark decontamination by SimHash over windows of the size of a benchmark item.

Three steps, all of them SQL expressions, each on less than the one before.

- Places. A window can only be as similar to an item as asked if it shares most of the
  item's shingles, so it holds at least a known number of any few more of them than may be
  missing. Those with the longest words are looked for in all texts. Where enough of them
  lie within the size of the item follows from running sums over their places, as stretches
  of window starts.
- Fingerprints. Each window of those stretches gets a SimHash of 128 bits over its words,
  the difference of two running sums. Two hashes within the radius agree on some block of
  16 bits but for ``radius // 8`` bits; both sides are joined on their blocks with a few
  bits flipped, so that none within the radius is missed.
- Verification. For each document and item that met, the exact weighted similarity of every
  window: shared shingles over all, each as often as it occurs. It changes only where a
  shingle of the item enters or leaves the window, so it too comes from running sums.

Nothing is written for a window but its place, and no step grows with the square of an
item's length.
"""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.shared import keyed, lower_words, written

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 31
BLOCKS, BLOCK_BITS = 8, 16

_HALF = 64  # bits of either hash of a word
_LANE = 31  # a sum holds the counts of two bits


def _shingles(words: str, size: str) -> Column:
    """Hashes of the runs of ``size`` words."""
    return F.expr(f"""transform(
        sequence(0, size({words}) - {size}), i -> xxhash64(slice({words}, i + 1, {size})))""")


_HASHES = {"one": "xxhash64(word)", "two": "xxhash64(word, 1)"}  # of a column ``word``


def _hashes() -> list[Column]:
    return [F.expr(value).alias(name) for name, value in _HASHES.items()]


def _bit_counts() -> list[Column]:
    """For each bit of the two hashes of a word whether it is set, two to a number."""
    return [F.expr(f"(shiftrightunsigned(one, {b}) & 1L) + shiftleft("
                   f"shiftrightunsigned(two, {b}) & 1L, {_LANE})")
            for b in range(_HALF)]


def _simhash(counts: str, words: str) -> list[Column]:
    """The two halves of the fingerprint from the counts of ``words`` words: each bit is the
    majority of theirs."""
    def half(count):
        return F.expr(f"""aggregate(sequence(0, {_HALF - 1}), 0L, (acc, b) -> acc | case when
            2 * {count} > {words} then shiftleft(1L, b) else 0L end)""")

    return [half(f"({counts}[b] & {2**_LANE - 1}L)").alias("one"),
            half(f"shiftright({counts}[b], {_LANE})").alias("two")]


def _flips(most: int) -> Column:
    """All numbers of a block's width with at most ``most`` bits set."""
    return F.array(*(F.lit(sum(1 << b for b in bits)) for n in range(most + 1)
                     for bits in combinations(range(BLOCK_BITS), n)))


def _blocks(flips: int) -> Column:
    """The blocks of a fingerprint, each also with up to ``flips`` bits changed."""
    cut = F.array(*(
        F.struct(F.lit(4 * h + k).alias("block"), F.expr(
            f"cast(shiftrightunsigned({half}, {BLOCK_BITS * k}) & {2**BLOCK_BITS - 1}L as int)"
        ).alias("bits")) for h, half in enumerate(("one", "two")) for k in range(4)))
    return F.flatten(F.transform(cut, lambda c: F.transform(
        _flips(flips), lambda f: F.struct(c.block, c.bits.bitwiseXOR(f).alias("bits")))))


def _distance(one: str, two: str) -> str:
    return f"bit_count({one}.one ^ {two}.one) + bit_count({one}.two ^ {two}.two)"


def benchmark_items(items: DataFrame) -> DataFrame:
    """Words, size, shingles and SimHash of each distinct item that has words; ``item`` tells
    them apart."""
    cut = items.select("item_id", lower_words(F.col("text")).alias("words")).filter(
        "size(words) > 0").distinct().withColumn("item", F.xxhash64("item_id", "words"))
    summed = cut.select("item", F.explode("words").alias("word")).select(
        "item", *_hashes()).groupBy("item").agg(
        F.count("*").alias("n"), *(F.sum(c).alias(f"b{b}") for b, c in enumerate(_bit_counts())))
    hashed = summed.select(
        "item", F.col("n").cast("int").alias("n"),
        F.array(*(f"b{b}" for b in range(_HALF))).alias("counts")).select(
        "item", "n", *_simhash("counts", "n"))
    return cut.join(hashed, "item").withColumn("k", F.expr(f"least({SHINGLE}, n)")).withColumn(
        "raw", _shingles("words", "k"))


def _looked_for(items: DataFrame, similarity: float) -> DataFrame:
    """The shingles of each item that are looked for, those with the longest words."""
    picked = items.select("n", "k", F.explode(F.expr(f"""
        slice(reverse(array_sort(transform(raw, (h, j) -> named_struct(
          'size', length(array_join(slice(words, j + 1, k), ' ')), 'hash', h)))), 1,
          size(raw) - cast(ceil({similarity} * size(raw)) as int) + 1)""")).alias("p"))
    return picked.select("n", "k", F.col("p.hash").alias("hash")).distinct()


def _least_shared(similarity: float) -> str:
    """SQL for how many shingles an item of n words and a window similar to it share at
    least: of the m and w that they have, both counted as often as they occur."""
    return (f"cast(ceil({similarity}D * ((n - k + 1) + (least(n, n_words) - k + 1))"
            f" / (1 + {similarity}D) - 1e-6D) as int)")


def _least_places(similarity: float) -> str:
    """SQL for how many of the shingles looked for a similar window holds at least: the
    item's others may all be among those shared."""
    m = "(n - k + 1)"
    return (f"greatest(1, {m} - cast(ceil({similarity} * {m}) as int) + 1 - {m}"
            f" + {_least_shared(similarity)})")


_LAST_START = "greatest(0, n_words - n)"


def _entering(places: DataFrame, *keys: str) -> DataFrame:
    """Where each place begins (+1) and ceases (-1) to lie in the window that starts ``at``."""
    return places.select(*keys, F.explode(F.expr("""array(
        named_struct('at', greatest(0, place + k - n), 'change', 1),
        named_struct('at', place + 1, 'change', -1))""")).alias("e")).select(
        *keys, "e.at", "e.change")


def _stretches(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Stretches of window starts, ``at`` to ``until``, with the sum of all ``change`` so far
    as ``held``. ``keys`` include n and n_words."""
    steps = changes.groupBy(*keys, "at").agg(F.sum("change").alias("change"))
    order = Window.partitionBy(*keys).orderBy("at")
    return steps.select(
        *keys, "at", F.sum("change").over(order).alias("held"),
        F.least(F.coalesce(F.lead("at").over(order) - 1, F.expr(_LAST_START)),
                F.expr(_LAST_START)).alias("until")).filter("at <= until")


def _shingle_places(docs: DataFrame, size: int) -> DataFrame:
    """One row for each run of ``size`` words: ``place`` and ``hash``."""
    return docs.filter(F.size("words") >= size).select(
        "doc_id", "mark", F.size("words").alias("n_words"),
        F.posexplode(_shingles("words", str(size))).alias("place", "hash"))


def _all_places(docs: DataFrame, sizes: list[int]) -> DataFrame | None:
    """The same for each of ``sizes`` (at most ``SHINGLE`` of them), as ``k``."""
    found = None
    for size in sizes:
        one = _shingle_places(docs, size).withColumn("k", F.lit(size))
        found = one if found is None else found.unionByName(one)
    return found


def _fingerprints(texts: DataFrame, starts: DataFrame) -> DataFrame:
    """SimHash of the windows ``starts`` (doc, n, k, n_words, start). ``texts`` has the words of
    their documents once.

    Both edges of every window stand as marks among the words; the running sums there are
    all that is kept, and a window's counts are their difference.
    """
    window = ["doc", "n", "k", "n_words", "start"]
    marks = starts.select(*window, F.explode(F.expr("""array(
        named_struct('at', start, 'sign', -1L),
        named_struct('at', least(start + n, n_words), 'sign', 1L))""")).alias("m")).select(
        *window, "m.at", "m.sign")
    words = texts.select("doc", F.posexplode("words").alias("at", "word")).select(
        "doc", "at", *_hashes())
    so_far = Window.partitionBy("doc").orderBy("at", F.col("one").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    sums = words.unionByName(marks, allowMissingColumns=True).select(
        *window, "sign", *(F.sum(c).over(so_far).alias(f"b{b}")
                           for b, c in enumerate(_bit_counts()))).where("sign is not null")
    counts = sums.groupBy(*window).agg(*(
        F.sum(F.coalesce(f"b{b}", F.lit(0)) * F.col("sign")).alias(f"b{b}")
        for b in range(_HALF)))
    return counts.select(
        "doc", "n", "k", "n_words", F.expr("least(n, n_words)").alias("own"),
        F.array(*(f"b{b}" for b in range(_HALF))).alias("counts")).select(
        "doc", "n", "k", "n_words", *_simhash("counts", "own"))


def contaminated(
    docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
) -> DataFrame:
    """One row for each document and benchmark item that share a passage: ``doc_id``,
    ``item_id``, ``similarity`` (the best window's), ``first_word`` (where the first such
    window starts), ``n_words`` (the item's size) and ``windows`` (how many there are).

    ``docs`` needs ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other columns
    are not read. Items without words, and null or empty texts, match nothing. Documents
    shorter than an item are compared whole. Repeated rows give one row; rows without an
    id count as one document. Items of fewer than five words match as a whole.
    """
    known = written(benchmark_items(items), "decontam-items")
    sizes = sorted(r.k for r in known.select("k").distinct().collect())  # five at most
    cut = docs.select("doc_id", F.xxhash64("text").alias("mark"),
                      lower_words(F.col("text")).alias("words"))
    places = _all_places(cut, sizes or [SHINGLE])
    # Spark broadcasts the shingles looked for while their table is below its size limit.
    looked_for = written(_looked_for(known, similarity), "decontam-shingles")
    keys = ["doc_id", "mark", "n", "k", "n_words"]
    hits = places.join(looked_for, ["hash", "k"]).select(*keys, "place").distinct()
    stretches = written(_stretches(_entering(hits, *keys), keys).filter(
        f"held >= {_least_places(similarity)}").withColumn(
        "doc", F.xxhash64("doc_id", "mark")), "decontam-stretches")

    # The words of the documents that have any, once.
    texts = written(keyed(cut, stretches.select("doc_id", "mark").distinct(), ["doc_id", "mark"])
                    .dropDuplicates(["doc_id", "mark"])
                    .withColumn("doc", F.xxhash64("doc_id", "mark")), "decontam-texts")
    starts = stretches.select("doc", "n", "k", "n_words", F.explode(
        F.sequence("at", "until")).alias("start"))
    ours = _fingerprints(texts, starts).select(
        "doc", "n_words", F.struct("one", "two").alias("ours"), "n", "k",
        F.explode(_blocks(1)).alias("b")).select("*", "b.block", "b.bits").drop("b")
    theirs = known.select(
        "item", F.struct("one", "two").alias("theirs"), "n", "k",
        F.explode(_blocks(radius // BLOCKS - 1)).alias("b")).select("*", "b.block", "b.bits").drop("b")
    met = ours.join(theirs, ["n", "k", "block", "bits"]).filter(
        f"{_distance('ours', 'theirs')} <= {radius}").select(
        "doc", "item", "n", "k", "n_words").distinct()

    # Exact similarity of all windows of the pairs that met.
    shingles = known.select("item", F.explode("raw").alias("hash")).groupBy("item", "hash").agg(
        F.count("*").alias("times"))
    wanted = written(met, "decontam-met")
    held = _all_places(texts, sizes or [SHINGLE]).withColumn(
        "doc", F.xxhash64("doc_id", "mark")).select("doc", "k", "place", "hash")
    pair = ["doc", "item", "n", "k", "n_words"]
    shared = held.join(wanted, ["doc", "k"]).join(shingles, ["item", "hash"]).select(
        *pair, "hash", "times", "place")
    steps = _entering(shared, *pair, "hash", "times").groupBy(*pair, "hash", "times", "at").agg(
        F.sum("change").alias("change"))
    order = Window.partitionBy(*pair, "hash", "times").orderBy("at")
    counted = steps.withColumn("count", F.least(F.sum("change").over(order), "times"))
    changes = counted.withColumn("change", F.col("count") - F.lag("count", 1, 0).over(order))
    size = "(n - k + 1) + (least(n, n_words) - k + 1)"
    close = _stretches(changes, pair).filter(f"held >= {_least_shared(similarity)}").groupBy(
        "doc", "item").agg(
        F.max(F.expr(f"held / ({size} - held)")).alias("similarity"),
        F.min("at").alias("first_word"), F.max("n").alias("n_words"),
        F.sum(F.col("until") - F.col("at") + 1).alias("windows"))
    named = close.join(texts.select("doc", "doc_id"), "doc").join(
        known.select("item", "item_id"), "item")
    return named.groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"),
        F.min("first_word").cast("long").alias("first_word"),
        F.max("n_words").cast("long").alias("n_words"),
        F.sum("windows").cast("long").alias("windows"))


def without_contaminated(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that hold a passage of the benchmark. Rows without an
    id are kept unless one of them holds such a passage."""
    bad = contaminated(docs, items, **how).select("doc_id").distinct()
    return keyed(docs, bad, ["doc_id"], "left_anti")
