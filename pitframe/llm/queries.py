"""The registered queries of the corpus operators and the SQL they must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from pitframe.llm import (clustering, exact_dedup, html_text, lexical_search, license_scan, minhash, mixing, packing, pii, quality_rules, suffix_dedup,
                          toxicity, warc)
from pitframe.llm.common import read_table


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"), across_lines=True)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(read_table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(read_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read_table(spark, sf_dir, "documents"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(read_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (
        pipeline, op1_mix_sources, op2_quality_rules, op3_license_scan, op4_suffix_dedup, op5_html_extraction, op6_best_fit_packing, op7_exact_dedup,
        op8_toxicity, op9_pii, op10_minhash_dedup, op11_ranked_search, op12_warc, op13_centroid_clustering)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": mixing.oracle(), "op2_quality_rules": quality_rules.oracle(), "op3_license_scan": license_scan.oracle(),
            "op4_suffix_dedup": suffix_dedup.ORACLE, "op7_exact_dedup": exact_dedup.ORACLE, "op10_minhash_dedup": minhash.ORACLE,
            "op11_ranked_search": lexical_search.ORACLE, "op12_warc": warc.oracle(), "op13_centroid_clustering": clustering.oracle()}
