"""One query for each operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import decontaminate, licenses, line_dedup, lm_score, mixing, ngram_join, pii, quality, rules, suffix_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def on(operator, *names):
        return lambda spark, sf_dir: operator(*(table(spark, sf_dir, n) for n in names))

    return {
        "op1_line_dedup": on(line_dedup.line_digest, "documents"),
        "op2_suffix_dedup": on(suffix_dedup.substring_digest, "documents"),
        "op3_source_mix": on(mixing.mix_digest, "documents"),
        "op4_license_scan": on(licenses.scan_licenses, "documents"),
        "op5_quality_rules": on(rules.rules_digest, "documents", "labels"),
        "op6_decontaminate": on(decontaminate.contaminated, "documents", "benchmark"),
        "op7_ngram_join": on(ngram_join.join_digest, "documents"),
        "op8_quality_classifier": on(quality.quality_digest, "documents", "labels"),
        "op9_lm_score": on(lm_score.lm_scores, "documents"),
        "op10_pii": on(pii.pii_digest, "documents"),
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE, "op3_source_mix": mixing.ORACLE, "op4_license_scan": licenses.oracle()}
