"""Corpus pipeline: filters, deduplicates and packs the ``documents`` table.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns a DataFrame, which is written as Parquet and read again as the next stage's
``docs``. All stages but the last return the columns of ``documents``.

Decisions. Each document is scored by a model fitted on labelled rows among the
stage's own input (the operators' held-out folds stay out); quality keeps what is
predicted 1, toxicity drops what is predicted 1. Of equal texts the row with the largest
doc_id stays, of a group of near duplicates the one with the smallest. Packing returns
one row per piece with its bin.

Defined results: rows that repeat as a whole count once from the first stage on; a
row without doc_id is kept unless its own text is rejected or repeated; an empty table
gives empty tables; without labels nothing is rejected.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from regpanel.llm import op1_toxicity, op2_packing, op4_minhash, op6_quality, op9_exact
from regpanel.llm.common import DOCUMENT_COLUMNS, read_table
from regpanel.session import checkpoint_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of good quality."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    model = op6_quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return op6_quality.keep_good(docs, model)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops toxic documents."""
    model = op1_toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return op1_toxicity.drop_toxic(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of equal texts."""
    return op9_exact.drop_duplicates(docs, op9_exact.half_by_id())


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return op4_minhash.drop_near_duplicates(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences."""
    return op2_packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("minhash near-dedup", near_stage),
    ("best-fit packing", packing_stage),
]

#: Trained classifiers cannot be expressed in SQL; see tests/llm/test_corpus_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    base = checkpoint_path(spark, f"corpus-{uuid.uuid4().hex}")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
    return docs
