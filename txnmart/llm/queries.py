"""One query per operator over the whole given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnmart.llm import (
    cotraining,
    decision_list,
    embed_dedup,
    hard_negatives,
    jaccard_join,
    langid,
    license_scan,
    mixing,
    packing,
    periodic_runs,
    secrets,
    suffix_dedup,
    toxicity,
)
from txnmart.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op2_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.quality_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).report()


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), packing.default_tokenizer)
    return packing.piece_report(pieces)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op9_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_report(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negative_report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decision_list": op2_decision_list,
    "op3_toxicity": op3_toxicity,
    "op4_mix_sources": op4_mix_sources,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_sum_of_squares_packing": op7_sum_of_squares_packing,
    "op8_language": op8_language,
    "op9_cotraining": op9_cotraining,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_license_scan": op12_license_scan,
    "op13_hard_negatives": op13_hard_negatives,
}
