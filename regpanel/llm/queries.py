"""The queries of the corpus operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_toxicity, op2_packing, op3_bpe, op4_minhash, op5_urls, op6_quality, op7_chat, op8_html, op9_exact, op10_ann, op11_whitening, op12_lines, op13_codes
from .common import read_table


def op1_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return op1_toxicity.score_toxicity(docs, op1_toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels")))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_packing.pack(read_table(spark, sf_dir, "documents"))


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_bpe.encode_documents(read_table(spark, sf_dir, "documents"), op3_bpe.Vocabulary.load(vocabulary_path()))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_urls.judge_urls(read_table(spark, sf_dir, "pages"))


def op6_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return op6_quality.score_quality(docs, op6_quality.fit_quality(docs, read_table(spark, sf_dir, "labels")))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_chat.conversation_digests(op7_chat.with_planted(read_table(spark, sf_dir, "conversations")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_exact.exact_duplicates(read_table(spark, sf_dir, "documents"), op9_exact.half_by_id())


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_html.extract_main_text(read_table(spark, sf_dir, "pages"))


def op10_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_ann.neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_whitening_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_whitening.whitened_rows(read_table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_lines.line_digests(op12_lines.dedup_lines(read_table(spark, sf_dir, "documents")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_codes.code_rows(*op13_codes.compress(read_table(spark, sf_dir, "embeddings")))


OP9_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (t)
"""

QUERIES = {
    "op1_toxicity": op1_toxicity_scores,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_bpe": op3_bpe_codec,
    "op4_near_dedup": op4_near_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_quality": op6_quality_scores,
    "op7_chat_format": op7_chat_format,
    "op8_main_text": op8_main_text,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_permutation_search": op10_permutation_search,
    "op11_whitening": op11_whitening_components,
    "op12_line_dedup": op12_line_dedup,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE_SQL = {
    "op5_url_filter": op5_urls.ORACLE_SQL,
    "op7_chat_format": op7_chat.ORACLE_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op12_line_dedup": op12_lines.ORACLE_SQL,
    "op13_vector_codes": op13_codes.ORACLE_SQL,
}
