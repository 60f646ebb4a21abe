"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dxweave.llm import alignment, byte_bpe, embeddings, filter_audit, language_id, language_model, near_duplicates, packing, quality, substrings, token_counts, toxicity, url_filters
from dxweave.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_decode(table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with remainder 1 are held out: the model never sees them."""
    docs, held_out = table(spark, sf_dir, "documents"), toxicity.in_part("doc_id", 3)
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_passages")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_copies(table(spark, sf_dir, "embeddings"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with remainder 1 are held out: the model never sees them."""
    docs, held_out = table(spark, sf_dir, "documents"), toxicity.in_part("doc_id", 5)
    scored = language_model.score(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with remainder 2 are held out: the model never sees them."""
    docs, held_out = table(spark, sf_dir, "documents"), toxicity.in_part("doc_id", 4, 2)
    predicted = language_id.predict(docs, language_id.train(docs.where(~held_out)))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_order_minhash": op2_order_minhash,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_byte_level_bpe": op4_byte_level_bpe,
    "op5_url_filters": op5_url_filters,
    "op6_token_counts": op6_token_counts,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_language_id": op12_language_id,
    "op13_filter_interaction_audit": op13_filter_interaction_audit,
}

ORACLES: dict[str, str] = {
    "op5_url_filters": url_filters.ORACLE,
    "op7_substring_dedup": substrings.ORACLE,
    "op9_embedding_dedup": embeddings.ORACLE,
    "op13_filter_interaction_audit": filter_audit.ORACLE,
}
