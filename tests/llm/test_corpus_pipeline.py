"""The pipeline on small tables, against what each stage promises."""

import re

import corpus_pipeline
from pyspark.sql import functions as F
from test_llm_operators import groups

from sortilex.llm.store import stored

SF = "/root/testdata/sf0.01"  # the smallest tables have 9 toxic labels to learn from, too few


def test_stages_in_turn(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_dedup", "decontamination", "pii", "mixing",
    ]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    bench = [r["text"].split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = corpus_pipeline.run(spark, SF).collect()
    kept = {r["doc_id"] for r in rows}
    assert kept <= set(texts) and len(kept) > 0.7 * len(texts)
    # At least most of what the labels call toxic goes, and little else by this rule.
    assert len(toxic - kept) >= 0.5 * len(toxic)
    words = {i: " ".join(texts[i].split()).lower() for i in kept}
    assert not any(" ".join(item).lower() in text for item in bench for text in words.values())
    assert len({t for t in words.values()}) == len(kept)
    for r in rows:
        assert not re.search(r"[\w.]+@mail\d\.example\.com", r["text"])
    assert {r["copy"] for r in rows} <= {0, 1}
    again = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["copy"]) for r in again.collect()) == sorted((r["doc_id"], r["copy"]) for r in rows)


def test_near_dedup_keeps_the_least_of_each_plain_group(spark):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    component, _ = groups([r["doc_id"] for r in rows], [r["text"] for r in rows])
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, small)
    assert kept.columns == docs.columns
    assert {r for r in kept.collect()} == {r for r in rows if component[r["doc_id"]] == r["doc_id"]}


def test_toxicity_leaves_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    clean = {r["doc_id"] for r in labels if r["toxic"] == 0}
    assert len(clean - kept) <= 0.02 * len(clean)


def test_stages_take_odd_rows_and_empty_tables(spark):
    """Nulls, empty and very long texts, repeated rows and clashing names through every stage."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    long = " ".join(f"w{i % 4999}" for i in range(40_000))
    texts = [None, "", " \n", "one", long, long, "mail jo@mail.example.com", "one"]
    rows = [(i, t, None, s, None) for i, t, s in zip([0, 1, 2, 3, 4, 5, None, 3], texts, "aabcdefa", strict=True)]
    odd = spark.createDataFrame(rows, documents.schema)
    for name in ("size", "copies", "kept", "n", "score", "fate", "__source", "__found", "found"):
        odd = odd.withColumn(name, F.lit("own"))
    for empty, docs in ((False, odd), (True, odd.limit(0))):
        own = docs.columns
        docs = stored(docs, "odd")
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stored(stage(spark, docs, SF), "odd")
            assert docs.columns == (own if i < 4 else [*own, "copy"])
            got = docs.collect()
            if i < 4:
                # One of the two long texts and one of the rows with id 3 go in the second stage.
                assert len(got) == (0 if empty else 8 if i == 0 else 6)
            assert all(r["size"] == r["kept"] == r["__found"] == "own" for r in got)
