from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from corpus_fixtures import edge_docs, no_docs, sf  # noqa: F401  (fixtures)
from regpanel.llm import op1_toxicity, op2_packing, op4_minhash, op6_quality
from test_dedup import brute_near


def test_stages_and_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "toxicity", "exact dedup", "minhash near-dedup", "best-fit packing"]


def test_pipeline_against_plain_python(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = corpus_pipeline.run(spark, sf_dir)

    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    model = op6_quality.fit_quality(docs, labels)
    rows = [r for r, s in zip(rows, model.scores([t for _, t in rows], op6_quality.RowCache())) if s >= 0.5]
    left = docs.where(F.col("doc_id").isin([i for i, _ in rows]))
    model = op1_toxicity.fit_toxicity(left, labels)
    rows = [r for r, s in zip(rows, model.scores([t for _, t in rows], op1_toxicity.WordCodes())) if s < 0.5]
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, i))
    rows = sorted((i, t) for t, i in last.items())
    groups = brute_near(rows)
    rows = [(i, t) for i, t in rows if groups[i] == i]
    assert set(r.doc_id for r in got.select("doc_id").distinct().collect()) == {i for i, _ in rows}
    tokens = {r.doc_id: r.n for r in docs.select("doc_id", F.regexp_count(F.col("text"), F.lit(op2_packing.TOKEN)).alias("n")).collect()}
    total = Counter()
    for r in got.collect():
        total[r.doc_id] += r.n_tokens
    assert total == Counter({i: tokens[i] for i, _ in rows})
    assert len(rows) > 100


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_edge_rows(spark, edge_docs, no_docs, stage, sf):
    plain = edge_docs.withColumn("doc_id", F.col("doc_id") + 10_000_000)
    out = stage(spark, plain, sf)
    assert out.count() > 0
    if stage is not corpus_pipeline.packing_stage:
        assert [c for c in out.columns if c != "score"] == list(corpus_pipeline.DOCUMENT_COLUMNS)
    assert stage(spark, no_docs, sf).collect() == []


def test_operators_alone_know_pairs(spark):
    # Near duplicates of different length classes stay apart at 0.8.
    docs = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(100))), (2, " ".join(f"a{i}" for i in range(60)))], "doc_id long, text string")
    assert {r.class_id for r in op4_minhash.near_duplicates(docs).collect()} == {1, 2}
