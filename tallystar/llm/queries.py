"""Registered queries ``opN_<name>``: each applies one operator to its whole tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import (
    cotraining, decontamination, hyperminhash, licenses, merkle, mixing, pii, recompression,
    spelling, suffix_array, suffix_tree, toxicity, wavelet,
)
from tallystar.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    mixed = mixing.mix(docs, F.col("words"))
    return mixed.select(
        "doc_id", "size", "source", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op2_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = suffix_tree.score_texts(docs, toxicity.fold(F.col("doc_id")) != 1)
    return scored.select(
        "doc_id", (toxicity.fold(F.col("doc_id")).eqNullSafe(F.lit(1))).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    scored = cotraining.score_quality(
        table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select(
        "doc_id", "content_score", "page_score", "score",
        F.col("good").cast("int").alias("predicted"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_array.remove_repeats(table(spark, folder, "documents"))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, folder, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    base = F.filter("spans", lambda s: s.kind != pii.TERM)
    return found.select(
        "doc_id", *(count(kind) for kind in pii.PATTERNS),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        count(pii.TERM))


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    scanned = licenses.scan_licenses(table(spark, folder, "documents"))

    def labels_of(*places):
        every = F.concat(*(F.transform(p, lambda x: x.label) for p in places))
        return F.array_join(F.array_sort(F.array_distinct(every)), ",")

    starts = F.transform("base", lambda x: x.start)
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels_of("base").alias("base_labels"), labels_of("base", "matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda x: x.score)), F.lit(0.0)).alias(
            "score"))


def op8_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = merkle.with_next(table(spark, folder, "documents").select("doc_id", "text"))
    changed = docs.withColumn("edited", merkle.edited(F.col("text"), F.col("next_text")))
    trees = changed.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        merkle.merkle_tree(F.col("text")).alias("tree"),
        merkle.merkle_tree(F.col("edited")).alias("edited_tree"),
        merkle.leaves(merkle.merkle_tree(F.col("next_text"))).alias("next_leaves"))
    with_leaves = trees.withColumn("own_leaves", merkle.leaves(F.col("tree")))
    return with_leaves.select(
        "doc_id", "n_chars", "edited_sha256",
        merkle.fingerprint(F.col("tree")).alias("fingerprint"),
        merkle.fingerprint(F.col("edited_tree")).alias("edited_fingerprint"),
        merkle.likeness(F.col("own_leaves"), merkle.leaves(F.col("edited_tree"))).alias(
            "near_edited"),
        merkle.likeness(F.col("own_leaves"), F.col("next_leaves")).alias("near_next"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    found = hyperminhash.near_duplicates(table(spark, folder, "documents"), size=4)
    return found.drop("mark")


def op11_recompression(spark: SparkSession, folder: str) -> DataFrame:
    cut = recompression.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_wavelet(spark: SparkSession, folder: str) -> DataFrame:
    cut = wavelet.fill_in_middle(table(spark, folder, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(wavelet.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_suffix_tree": op2_suffix_tree,
    "op3_cotraining": op3_cotraining,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_array": op5_suffix_array,
    "op6_pii": op6_pii,
    "op7_licenses": op7_licenses,
    "op8_merkle": op8_merkle,
    "op9_decontamination": op9_decontamination,
    "op10_hyperminhash": op10_hyperminhash,
    "op11_recompression": op11_recompression,
    "op12_wavelet": op12_wavelet,
    "op13_spelling": op13_spelling,
}
