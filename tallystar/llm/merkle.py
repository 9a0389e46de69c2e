"""Document fingerprints: Merkle trees over sections, paragraphs and their pieces.

A text is cut into sections (at blank lines, and after every eighth paragraph),
paragraphs (at line ends) and pieces (sentences, at most 64 characters long). A paragraph
hashes its pieces whole, a section its paragraphs and the root its sections, each with 256
bits; pieces also have short hashes of their own, which likeness compares. Equal roots mean
equal texts; where roots differ, the branches that differ say where the
texts do. Everything is SQL expressions.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = r"[^.\n]{0,63}+\.?\n|[^.\n]{0,63}+\.|[^.\n]{1,64}+"
SECTION_PARAGRAPHS = 8
LEAF_HEX = 16
BUCKET_BYTES = 16 << 20
MOST_BUCKETS = 20000
_NULL_BUCKETS = 10


def _kept(parts: Column) -> Column:
    return F.filter(parts, lambda part: part != "")


def merkle_tree(text: Column) -> Column:
    """struct<root, sections: array<struct<hash, paragraphs: array<struct<hash, leaves>>>>>.

    A null text is empty; an empty text has no sections.
    """

    def paragraph(part: Column) -> Column:
        # Its pieces are all of a paragraph, so this hashes them whole, one after another.
        pieces = F.regexp_extract_all(part, F.lit(PIECE), F.lit(0))
        return F.struct(F.sha2(part, 256).alias("hash"), F.transform(
            pieces, lambda piece: F.substring(F.md5(piece), 1, LEAF_HEX)).alias("leaves"))

    def hashed_paragraphs(group: Column) -> Column:
        return F.transform(group, paragraph)

    def groups(section: Column) -> Column:
        paragraphs = _kept(F.split(section, r"(?<=\n)"))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(paragraphs), F.lit(1)),
                            F.lit(SECTION_PARAGRAPHS))
        return F.transform(firsts, lambda first: F.slice(paragraphs, first, SECTION_PARAGRAPHS))

    parts = _kept(F.split(F.coalesce(text, F.lit("")), r"(?<=\n\n)"))
    sections = F.transform(F.flatten(F.transform(parts, groups)), hashed_paragraphs)
    hashed = F.transform(sections, lambda s: F.struct(
        F.sha2(F.array_join(F.transform(s, lambda p: p.hash), ""), 256).alias("hash"),
        s.alias("paragraphs")))
    return hashed


def root(sections: Column) -> Column:
    return F.sha2(F.array_join(F.transform(sections, lambda s: s.hash), ""), 256)


def leaves(sections: Column) -> Column:
    """All leaf hashes of a tree, each once."""
    return F.array_distinct(F.flatten(F.transform(
        sections, lambda s: F.flatten(F.transform(s.paragraphs, lambda p: p.leaves)))))


def fingerprint(sections: Column) -> Column:
    """The tree as text: root:section[leaf.leaf,leaf] section[...], paragraphs by commas."""
    written = F.transform(sections, lambda s: F.concat(
        F.substring(s.hash, 1, LEAF_HEX), F.lit("["),
        F.array_join(F.transform(s.paragraphs, lambda p: F.array_join(p.leaves, ".")), ","),
        F.lit("]")))
    return F.concat(root(sections), F.lit(":"), F.array_join(written, " "))


def likeness(ours: Column, theirs: Column) -> Column:
    """Twice the shared leaves over all leaves of two leaf sets: 1 if equal, 0 if disjoint."""
    total = F.size(ours) + F.size(theirs)
    shared = F.size(F.array_intersect(ours, theirs))
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * shared / total)


def differing_branches(ours: Column, theirs: Column) -> Column:
    """Where two trees differ: for each section of ``ours`` that ``theirs`` lacks, its number
    and the numbers of its paragraphs that ``theirs`` lacks, from 0."""
    other_sections = F.transform(theirs, lambda s: s.hash)
    other_paragraphs = F.flatten(F.transform(
        theirs, lambda s: F.transform(s.paragraphs, lambda p: p.hash)))
    numbered = F.transform(ours, lambda s, i: F.struct(
        i.alias("section"), s.hash.alias("hash"),
        F.filter(
            F.transform(s.paragraphs, lambda p, k: F.when(
                ~F.array_contains(other_paragraphs, p.hash), k)),
            lambda k: k.isNotNull()).alias("paragraphs")))
    changed = F.filter(numbered, lambda s: ~F.array_contains(other_sections, s.hash))
    return F.transform(changed, lambda s: F.struct(s.section, s.paragraphs))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Add ``sections`` (the tree), ``root`` and ``fingerprint`` to ``docs``; null is empty."""
    own = [c for c in docs.columns if c not in ("sections", "root", "fingerprint")]
    return docs.select(*own, merkle_tree(F.col("text")).alias("sections")).withColumns(
        {"root": root(F.col("sections")), "fingerprint": fingerprint(F.col("sections"))})


def _bucket(docs: DataFrame) -> Column:
    """Number of the range of ids that a row is in, about ``BUCKET_BYTES`` of text each;
    rows without id come below all others, by hash of the text. There are at most
    ``MOST_BUCKETS`` ranges, which bounds the cuts and the table of their first ids; beyond
    that they grow, and Spark sorts them with what spills."""
    size, ids = docs.agg(F.sum(F.octet_length("text")), F.count("doc_id")).first()
    count = min(max(1, math.ceil((size or 0) / BUCKET_BYTES)), MOST_BUCKETS)
    cuts: list[int] = []
    if ids and count > 1:
        shares = [i / count for i in range(1, count)]
        cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 100 * count)).first()[0]))
    width = max(1, math.isqrt(len(cuts)))
    rows = [cuts[i:i + width] for i in range(0, len(cuts), width)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda cut: cut <= F.col("doc_id")))

    place = F.lit(0)
    if rows:
        row = below(F.array(*(F.lit(r[0]) for r in rows)))
        table = F.array(*(F.array(*map(F.lit, r)) for r in rows))
        place = F.when(row == 0, 0).otherwise(
            (row - 1) * width + below(F.element_at(table, F.greatest(row, F.lit(1)))))
    nulls = F.shiftright("_mark", 64 - _NULL_BUCKETS) - (1 << (_NULL_BUCKETS - 1)) - 1
    return F.when(F.col("doc_id").isNull(), nulls).otherwise(place.cast("long"))


def with_next(docs: DataFrame) -> DataFrame:
    """Add ``next_text``: the text of the next document by descending id, the first one's
    after the last. Rows with equal ids go by a hash of their text; null ids come last.

    Rows are dealt into ranges of ids once. Within a range a window looks one row ahead;
    the last row of a range takes the first row of the next range, of which there is one
    for each range.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = [c for c in docs.columns if c != "next_text"]
    rows = docs.select(F.struct(*(c for c in own if c != "text")).alias("row"), "doc_id",
                       text.alias("text"))
    rows = rows.withColumn("_mark", F.xxhash64("text"))
    rows = rows.withColumn("_bucket", _bucket(rows))
    order = (F.col("doc_id").desc_nulls_last(), F.col("_mark").desc())
    tops = rows.groupBy("_bucket").agg(F.max("doc_id").alias("_top"))
    heads = (
        rows.select("_bucket", "doc_id", "_mark", "text").join(
            F.broadcast(tops.select(F.col("_bucket").alias("_b"), "_top")),
            (F.col("_bucket") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_top")))
        .groupBy("_bucket").agg(F.max(F.struct("_mark", "text")).alias("_first"))
    )
    down = Window.orderBy(F.col("_bucket").desc())  # one row for each range
    whole = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        F.col("_bucket").alias("_b"),
        F.coalesce(F.lead("_first.text").over(down), F.first("_first.text").over(whole)).alias(
            "_head"))
    ahead = Window.partitionBy("_bucket").orderBy(*order)
    following = rows.withColumn("next_text", F.lead("text").over(ahead))
    joined = following.join(heads, F.col("_bucket") == F.col("_b"), "left")
    return joined.select(
        *(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in own),
        F.coalesce("next_text", "_head").alias("next_text"))


def edited(text: Column, next_text: Column) -> Column:
    """The last third of the characters replaced by as many of the next text's first."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.left(text, F.length(text) - third), F.left(next_text, third))
