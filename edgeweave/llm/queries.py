"""The named queries of this folder: each takes ``(spark, sf_dir)`` and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edgeweave.llm import (
    divergence,
    graph_index,
    mixing,
    packing,
    pii,
    quality,
    resampling,
    simhash,
    suffixes,
    topk,
    url_filter,
    warc,
    wrappers,
)
from edgeweave.sources.derived import table

Query = Callable[[SparkSession, str], DataFrame]


def _every_20th() -> Column:
    return F.col("vec_id") % 20 == 0


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), _every_20th())


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def word_vocabulary() -> str:
    """Where the word-level BPE vocabulary of the packing query lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), word_vocabulary())


def op6_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_texts(table(spark, sf_dir, "pages"))


def op7_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


def op8_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).drop("url")


def op9_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_index.nearest(table(spark, sf_dir, "embeddings"), _every_20th())


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_counts(table(spark, sf_dir, "documents"))


def op11_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op12_head_tail_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_count_cell_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_exact_top_k": op1_exact_top_k,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_simhash": op3_simhash,
        "op4_temperature_mixing": op4_temperature_mixing,
        "op5_hilbert_packing": op5_hilbert_packing,
        "op6_wrapper_text": op6_wrapper_text,
        "op7_url_verdicts": op7_url_verdicts,
        "op8_warc_members": op8_warc_members,
        "op9_graph_neighbours": op9_graph_neighbours,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_weak_pii": op11_weak_pii,
        "op12_head_tail_resampling": op12_head_tail_resampling,
        "op13_count_cell_audit": op13_count_cell_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": topk.TOP_K_SQL,
        "op4_temperature_mixing": mixing.MIXTURE_SQL,
        "op7_url_verdicts": url_filter.url_verdicts_sql(),
        "op8_warc_members": warc.ARCHIVED_SQL,
        "op12_head_tail_resampling": resampling.RESAMPLED_SQL,
        "op13_count_cell_audit": divergence.AUDIT_SQL,
    }
