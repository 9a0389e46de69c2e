"""Personal data: fixed patterns, and terms that give a protected entity away.

Patterns find emails, IP addresses, card and phone numbers. Each distinct value is a
protected entity. The corpus says how strongly a word reveals an entity: the pointwise
mutual information of the two, counted in whole documents, as a share of the entity's own
information. At a share of 1 whoever reads the word knows the entity. In documents that
mention the entity, words over the upper threshold are removed and words between the
thresholds are generalised to what kind of word they are. Everything is SQL expressions.

Words in too many documents to reach the lower threshold are left out first. Entities found
in the same documents are counted as one, and so are words: a document with very many of
both has few such groups, and no pair of an entity and a word is written.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.shared import keyed, lower_words, packed, unpacked, written

# The patterns of the kinds, in the order in which spans are listed. A match
# that could begin further left would, unless it follows another one (\G), so starting
# elsewhere is not tried; possessive repeats are those that never have to give back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must match for a pattern to be tried.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
TERM = "term"

SUPPORT = 3
GENERALISE = 0.7
REMOVE = 0.9
SPAN = "struct<start:int,rank:int,kind:string,end:int,value:string,action:string>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"

_LUHN = """
    aggregate(sequence(1, length(x.digits)), 0, (sum, i) -> sum + case
        when i % 2 = 1 then cast(substring(x.digits, -i, 1) as int)
        else 2 * cast(substring(x.digits, -i, 1) as int)
             - case when cast(substring(x.digits, -i, 1) as int) > 4 then 9 else 0 end
        end) % 10 = 0"""
VALID = {
    "email": "true",
    "ip": "forall(split(x.value, '[.]'), p -> length(regexp_replace(p, '^0+', '')) <= 3 "
          "and coalesce(try_cast(regexp_replace(p, '^0+', '') as int), 0) <= 255)",
    "card": f"case when length(x.digits) between 12 and 19 then {_LUHN} else false end",
    "phone": "length(x.digits) between 9 and 15",
}


def _places(text: str, pattern: str) -> str:
    """SQL for the matches of ``pattern`` in a text that has some: structs of start, end
    (code points), value and its digits. The parts between matches say where they stand."""
    return f"""
        aggregate(
          sequence(0, size(regexp_extract_all({text}, {pattern}, 0)) - 1),
          named_struct('at', 0, 'parts', split({text}, {pattern}, -1),
            'matches', regexp_extract_all({text}, {pattern}, 0), 'found',
            cast(array() as array<struct<start:int,end:int,value:string,digits:string>>)),
          (acc, i) -> named_struct(
            'at', acc.at + length(acc.parts[i]) + length(acc.matches[i]),
            'parts', acc.parts, 'matches', acc.matches,
            'found', array_append(acc.found, named_struct(
              'start', acc.at + length(acc.parts[i]),
              'end', acc.at + length(acc.parts[i]) + length(acc.matches[i]),
              'value', acc.matches[i],
              'digits', regexp_replace(acc.matches[i], '[^0-9]', '')))),
          acc -> acc.found)"""


def base_spans(text: str = "text") -> Column:
    """Spans of the patterns in the column ``text``, by start and kind; none for null."""
    kinds = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        quoted = f"r'{pattern}'"
        kinds.append(f"""
            case when `{text}` rlike r'{NEEDED[kind]}' and `{text}` rlike {quoted} then
              transform(filter({_places(f"`{text}`", quoted)}, x -> {VALID[kind]}),
                x -> named_struct('start', x.start, 'rank', {rank}, 'kind', '{kind}',
                  'end', x.end, 'value', x.value, 'action', 'remove'))
            else {NO_SPANS} end""")
    return F.expr(f"""
        case when `{text}` rlike '[0-9@]' then array_sort(concat({', '.join(kinds)}))
        else {NO_SPANS} end""")


def _entity(span: Column) -> Column:
    return F.concat(span.kind, F.lit(":"), F.lower(span.value))


DOC = ["doc_id", "mark"]


def _once(rows: DataFrame) -> DataFrame:
    """``rows`` with those that repeat in id and text once. Only rows that do are moved."""
    repeated = written(rows.groupBy(*DOC).agg(F.count("*").alias("n")).where("n > 1").select(*DOC),
                       "pii-repeated")
    if repeated.isEmpty():
        return rows
    return keyed(rows, repeated, DOC, "left_anti").unionByName(
        keyed(rows, repeated, DOC).dropDuplicates(DOC))


def _words_of(text: str) -> Column:
    """One row for each distinct word of a text."""
    return F.explode(F.array_distinct(lower_words(F.col(text))))


def _grouped(pairs: DataFrame, name: str) -> DataFrame:
    """``doc`` and ``name`` pairs with the group of names found in the very same documents:
    128 bits of the set of those and its size."""
    groups = pairs.groupBy(name).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("doc")).alias("one"),
        F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("two"))
    return pairs.join(groups.select(name, F.struct("n", "one", "two").alias(f"{name}_group")), name)


def disclosing_terms(
    docs: DataFrame, found: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE,
) -> DataFrame:
    """``doc_id``, ``mark``, ``term`` and ``share`` for the documents that mention an entity:
    the terms that give one of theirs away, and the largest share of an entity's information
    that the term has, of at least ``generalise``. Terms have to stand in at least
    ``support`` documents with the entity. Counted over all documents.

    ``docs`` has ``doc_id``, ``mark`` and ``text`` of each document once, ``found`` those with
    spans: also ``spans``. A term of n documents shares at most log2(all / n) with an
    entity, which bounds n.
    """
    n_docs = F.lit(float(docs.count()))
    doc = F.struct(*DOC).alias("doc")
    mentions = written(found.select(doc, F.explode("spans").alias("s")).select(
        "doc", _entity(F.col("s")).alias("entity")).distinct(), "pii-mentions")
    most = (1 + 1e-9) * F.pow(n_docs, F.lit(1.0 - generalise)) * F.pow(
        "entity_group.n", F.lit(generalise))
    entities = written(_grouped(mentions, "entity").where(
        F.col("entity_group.n") >= support).select("doc", "entity_group", most.alias("most"))
        .distinct(), "pii-entities")
    limit = entities.agg(F.max("most")).first()[0] or 0.0
    counts = docs.select(_words_of("text").alias("term")).groupBy("term").agg(
        F.count("*").alias("n_term")).where(F.col("n_term").between(support, limit))
    words = written(found.select(doc, "text").join(
        entities.select(F.col("doc").alias("of")).distinct(), F.col("doc").eqNullSafe(F.col("of")),
        "left_semi").select("doc", _words_of("text").alias("term")).join(counts, "term"),
        "pii-words")
    # Documents without an entity count for a term, but in no pair: the term's group is that
    # of its documents with one, beside the number of all.
    terms = written(_grouped(words, "term").select(
        "doc", "term", F.struct("term_group", "n_term").alias("term_group")), "pii-terms")
    either = terms.select(F.col("doc").alias("of"), "term_group").distinct()
    pairs = entities.join(either, F.col("doc").eqNullSafe(F.col("of")) & (
        F.col("term_group.n_term") <= F.col("most"))).groupBy("entity_group", "term_group").agg(
        F.count("*").alias("n_both")).where(F.col("n_both") >= support)
    n_entity, n_term = F.col("entity_group.n"), F.col("term_group.n_term")
    own = F.log2(n_docs / n_entity)
    shared = F.log2(F.col("n_both") * n_docs / (n_entity * n_term))
    telling = pairs.withColumn("share", F.when(own > 0, shared / own).otherwise(0.0)).where(
        F.col("share") >= generalise).select("entity_group", "term_group", "share")
    here = entities.join(telling, "entity_group").groupBy("doc", "term_group").agg(
        F.max("share").alias("share")).withColumnRenamed("doc", "of")
    return terms.join(here, "term_group").where(F.col("doc").eqNullSafe(F.col("of"))).select(
        "doc.doc_id", "doc.mark", "term", "share")


def find_personal_data(
    docs: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE,
) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text) and ``spans`` of every row of ``docs``: those
    of the patterns (action ``remove``) and of disclosing terms (``remove`` or
    ``generalise``), by start and kind, in code points, end exclusive.

    A null or empty text has no spans. Rows equal in id and text count as one document in
    the statistics and each get their own result. Without rows there is nothing.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    searched = rows.withColumn("spans", base_spans())
    every = written(searched.select(
        "doc_id", "mark", "spans", F.when(F.size("spans") > 0, F.col("text")).alias("text")), "pii")
    found = every.filter("size(spans) > 0").dropDuplicates(DOC)
    by_doc = disclosing_terms(_once(rows), found, support, generalise).groupBy(*DOC).agg(
        F.collect_list(F.struct("term", "share")).alias("terms"))
    of = by_doc.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "terms")
    joined = every.join(
        of, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    pattern = r"""concat(r'(?iu)(?<![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])(?:',
        array_join(transform(terms, t -> t.term), '|'),
        r')(?![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])')"""
    placed = joined.withColumn("_pattern", F.expr(
        f"case when size(terms) > 0 then {pattern} end"))
    added = F.expr(f"""
        case when _pattern is not null and text rlike _pattern then
          transform(
            filter({_places("text", "_pattern")},
              x -> not exists(spans, s -> s.start < x.end and x.start < s.end)),
            x -> named_struct('start', x.start, 'rank', {len(PATTERNS)}, 'kind', '{TERM}',
              'end', x.end, 'value', x.value, 'action',
              case when coalesce(array_max(transform(filter(terms, t -> t.term = lower(x.value)),
                t -> t.share)), 1.0) >= {remove} then 'remove' else 'generalise' end))
        else {NO_SPANS} end""")
    return placed.select(
        "doc_id", "mark", F.array_sort(F.concat("spans", added)).alias("spans"))


def _replacement(span: str) -> str:
    """What stands in place of a span: its kind, or for a generalised word its form."""
    return f"""
        case when {span}.kind <> '{TERM}' then concat('[', upper({span}.kind), ']')
             when {span}.action = 'remove' then ''
             when {span}.value rlike '^[0-9]+$' then '[NUMBER]'
             when {span}.value rlike '[0-9]' then '[CODE]'
             else '[WORD]' end"""


def sanitised(text: str, spans: str) -> Column:
    """The text with its spans replaced; of overlapping ones the first stands for all."""
    return F.expr(f"""
        case when size({spans}) > 0 then aggregate(
          {spans}, named_struct('at', 0, 'out', ''),
          (acc, s) -> named_struct(
            'at', greatest(acc.at, s.end),
            'out', case when s.start >= acc.at then concat(
              acc.out, substring({text}, acc.at + 1, s.start - acc.at), {_replacement('s')})
              else acc.out end),
          acc -> concat(acc.out, substring({text}, acc.at + 1)))
        else {text} end""")


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` brought up to date.

    Only rows with something to replace are joined with their spans.
    """
    found = find_personal_data(docs, **thresholds).filter("size(spans) > 0").dropDuplicates(DOC)
    rows = packed(docs, doc_id=F.col("doc_id"), own=F.xxhash64("text"), text=F.col("text"))
    spans = found.select(F.col("doc_id").alias("of"), "mark", "spans")
    joined = rows.join(
        spans, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("own") == F.col("mark")), "left")
    clean = joined.withColumn("clean", F.when(
        F.col("spans").isNull(), F.col("text")).otherwise(sanitised("text", "spans")))
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(
            F.length("clean").cast(kind))
    return unpacked(clean, docs.columns, **changed)
