"""The pipeline over small tables, each stage against what its own input asks for."""

from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import SMOKE
from stockledger.llm.scratch import written
from tests.llm.rows import clashing, documents
from tests.llm.test_lines import decided
from tests.llm.test_near_duplicates import brute_force

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").where("doc_id < 120")
    names = docs.columns
    docs = written(STAGES["language_id"](spark, docs, SMOKE), "t")
    assert docs.columns == names and docs.count() == 120

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = decided(rows)
    docs = written(STAGES["line_dedup"](spark, docs, SMOKE), "t")
    wanted = {}
    for i, text in rows:
        own = [line for n, line in enumerate(text.split("\n")) if kept.get((i, n), (0, True))[1]]
        if any((i, n) in kept and kept[i, n][1] for n in range(len(text.split("\n")))):
            wanted[i] = "\n".join(own)
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == wanted

    docs = written(STAGES["near_dedup"](spark, docs, SMOKE), "t")
    left = {i for i, _, _, stays in brute_force(list(wanted.items())) if stays}
    assert {r["doc_id"] for r in docs.collect()} == left and docs.columns == names

    mixed = written(STAGES["mixing"](spark, docs, SMOKE), "t")
    assert mixed.columns == names and mixed.join(docs, names, "left_anti").count() == 0
    pieces = STAGES["packing"](spark, mixed, SMOKE)
    starts = pieces.where("start = 0").groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in starts} == {
        r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()
    }


def test_edge_rows_pass_through(spark):
    docs = clashing(documents(spark)).withColumn("lang", F.when(F.col("doc_id") < 9, F.lit("xx")))
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SMOKE), "t")
        if name != "packing":
            assert docs.columns == before.columns
    assert docs.count() > 0


def test_no_documents(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMOKE), "t")
    assert docs.count() == 0
