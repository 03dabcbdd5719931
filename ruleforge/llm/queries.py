"""One query for each corpus operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import best_fit, chat_format, chunk_dedup, decontaminate, divergence, embedding_dedup, html_extract, minhash_dedup, periodic, quality_lm, source_mix, suffix_dedup, toxicity
from .common import table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start_word", "n_words")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql("SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return chat_format.digests(chat_format.typed(turns.unionByName(own)))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.digests(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.counted(table(spark, sf_dir, "pages"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.summaries(table(spark, sf_dir, "documents"))


QUERIES = (op1_benchmark_decontamination, op2_chat_formatting, op3_quality_classifier, op4_source_mixing, op5_toxicity, op6_minhash_dedup, op7_substring_dedup, op8_embedding_dedup, op9_html_extraction, op10_suffix_dedup, op11_best_fit_packing, op12_source_divergence, op13_periodic_runs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express an operator. No short SQL gives the fitted models, the splitting tree, page trees, rolling hashes or a tokenizer."""
    return {
        "op1_benchmark_decontamination": decontaminate.ORACLE,
        "op2_chat_formatting": chat_format.ORACLE,
        "op6_minhash_dedup": minhash_dedup.ORACLE,
        "op8_embedding_dedup": embedding_dedup.ORACLE,
        "op10_suffix_dedup": suffix_dedup.ORACLE,
        "op12_source_divergence": divergence.ORACLE,
        "op13_periodic_runs": periodic.ORACLE,
    }
