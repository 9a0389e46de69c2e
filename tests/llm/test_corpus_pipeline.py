"""The registered queries over the smallest tables, and the pipeline stage by stage."""
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tallystar.llm import pii

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

# The columns each query promises.
COLUMNS = {
    1: "doc_id size source_size target taken",
    2: "doc_id held_out n_tokens n_known train_tokens base_score score",
    3: "doc_id content_score page_score score predicted",
    4: "doc_id held_out score predicted",
    5: "doc_id n_bytes n_removed n_spans kept_sha256",
    6: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    7: "doc_id n_words n_base first_word last_word base_labels labels score",
    8: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    9: "doc_id item_id similarity first_word n_words windows",
    10: "doc_id n_shingles component_id kept",
    11: "doc_id n_words n_removed kept_sha256",
    12: "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    13: "word form root n n_near form_n",
}


def name_of(number):
    return next(n for n in contract.queries() if n.startswith(f"op{number}_"))


@pytest.mark.parametrize("number", COLUMNS)
def test_queries(spark, number):
    df = contract.queries()[name_of(number)](spark, FOLDER)
    assert set(COLUMNS[number].split()) <= set(df.columns)
    rows = df.collect()
    whole = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert len(rows) > 0 and (number in (9, 13) or len(rows) == whole)


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def alike(a, b):
    return len(a & b) * 100 >= 80 * len(a | b) > 0


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality
              for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = [{r.doc_id: r for r in docs.collect()}]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, FOLDER)
        if number < 4:
            assert after.columns == docs.columns
        rows = after.collect()
        kept.append({r.doc_id: r for r in rows})
        assert len(kept[-1]) == len(rows)
        docs = spark.createDataFrame(rows, after.schema)
    before, good, single, clean, safe, mixed = kept
    wrong = sum((labels[d] == 1) != (d in good) for d in before if d in labels)
    assert wrong <= 0.05 * len(labels)
    sets = {d: shingles(r.text) for d, r in good.items()}
    for d in good:
        twins = [e for e in good if e < d and alike(sets[d], sets[e])]
        assert d in single or twins
        assert d not in single or not any(e in single for e in twins)
    for d, r in single.items():
        assert (d in clean) != any(" ".join(item.split()) in " ".join(r.text.split())
                                   for item in items)
    assert clean.keys() == safe.keys()
    left = spark.createDataFrame([(r.text,) for r in safe.values()], "text string").where(
        F.size(pii.base_spans()) > 0)
    assert left.count() == 0
    assert all(r.text == clean[d].text or "[" in r.text for d, r in safe.items())
    assert all(len(r.text) == r.n_chars for r in safe.values())
    for source in {r.source for r in safe.values()}:
        taken = sum(r.size * r.copies for r in mixed.values() if r.source == source)
        target = next((r.target for r in mixed.values() if r.source == source), 0)
        longest = max(len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
                      for r in safe.values() if r.source == source)
        assert abs(taken - target) <= longest


def test_run_registers(spark):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, FOLDER).where("copies between 1 and 2").count() > 50


@pytest.fixture
def folder(spark, documents, tmp_path):
    """Tables with nulls in every column, empty, long and repeated texts."""
    item = " ".join(f"item{i}" for i in range(30))
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    rows = [(i, own(i), f"s{i % 2}") for i in range(12)]
    rows += [(20, None, "s0"), (21, "", "s1"), (22, " \n", None), (None, own(50), "s0"),
             (None, None, None), (23, own(3) + " more", "s1"), (3, own(3), "s1"),
             (24, f"{own(60)} {item} end", "s0"), (25, own(70) + " mail a.b@c.org now", "s1"),
             (26, own(80) + " long" * 30000, "s0")]
    docs = documents(rows)
    docs = docs.unionByName(docs.limit(0)).withColumn(
        "lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang"))).withColumn("extra", F.lit("x"))
    tables = {
        "documents": docs,
        "labels": spark.createDataFrame(
            [(i, 1, 0) for i in range(12)] + [(None, 0, 1), (999, None, None)],
            "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame(
            [(1, item), (2, None), (3, ""), (None, "null id item of some few words here")],
            "item_id long, text string"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_stages_on_odd_rows(spark, folder):
    found = {}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, folder)
        rows = after.collect()
        found[name] = sorted(str(r.doc_id) for r in rows)
        if number < 4:
            assert after.columns == list(corpus_pipeline.COLUMNS)
        docs = spark.createDataFrame(rows, after.schema)
        if name == "personal_data":
            texts = {r.doc_id: r.text for r in rows}
    assert found["quality"].count("3") == 2  # all labels are good, so all rows are kept
    assert found["near_duplicates"].count("3") == 1 and "23" not in found["near_duplicates"]
    assert {"20", "21", "22", "None"} <= set(found["near_duplicates"])
    assert "24" in found["near_duplicates"] and "24" not in found["decontaminate"]
    assert found["personal_data"] == found["decontaminate"]
    assert "[EMAIL]" in texts[25] and "a.b@c.org" not in texts[25] and texts[20] is None


def test_run_over_odd_and_empty_tables(spark, folder, tmp_path):
    mixed = corpus_pipeline.run(spark, folder).collect()
    assert mixed and all(1 <= r.copies <= 2 for r in mixed)
    empty = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(
            f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).collect() == []
