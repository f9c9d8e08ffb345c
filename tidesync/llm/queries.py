"""The operators' queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat,
    decontaminate,
    licenses,
    line_dedup,
    merkle,
    mixing,
    periodic,
    quality_rules,
    secret_scan,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": simhash.op1_simhash,
    "op2_url_filters": url_filter.op2_url_filters,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_secret_scans": secret_scan.op5_secret_scans,
    "op6_mixing": mixing.op6_mixing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "quality_ablation": quality_rules.quality_ablation,
    "op9_benchmark_decontamination": decontaminate.op9_benchmark_decontamination,
    "benchmark_proximity": decontaminate.benchmark_proximity,
    "op10_license_scans": licenses.op10_license_scans,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_chat_formatting": chat.op13_chat_formatting,
}

ORACLE: dict[str, str] = {
    "op3_line_dedup": line_dedup.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op8_quality_rules": quality_rules.ORACLE,
    "quality_ablation": quality_rules.ABLATION_ORACLE,
    "op9_benchmark_decontamination": decontaminate.ORACLE,
    "benchmark_proximity": decontaminate.PROXIMITY_ORACLE,
    "op10_license_scans": licenses.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op13_chat_formatting": chat.ORACLE,
}
