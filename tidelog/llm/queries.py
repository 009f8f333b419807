"""The thin opN_<name> queries of the training-data operators, with their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import block_repeats, fingerprints, html_text, licenses, merkle, minhash, mixing, oracles, packing, prefix_trie, quality, secrets, suffix_repeats, tokens
from tidelog.llm.common import documents


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.attribute(documents(spark, sf_dir))


def op2_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.remove(documents(spark, sf_dir), keep_first=False)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op7_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(documents(spark, sf_dir))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.take(documents(spark, sf_dir), "doc_id")


def op9_fixed_block_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_repeats.remove(documents(spark, sf_dir))


def op10_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(documents(spark, sf_dir))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.of_rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_token_counts, op2_suffix_repeats, op3_license_scan, op4_html_text, op5_quality_rules, op6_best_fit_packing, op7_minmax_near_dedup, op8_source_mix, op9_fixed_block_repeats,
        op10_syncmer_fingerprints, op11_merkle_manifest, op12_secret_scan, op13_prefix_trie,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
