"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from conewise.llm import (
    divergence,
    exact_dedup,
    jaccard_join,
    license_scan,
    line_dedup,
    merkle,
    packing,
    pii,
    piece_encoding,
    quality,
    substring_dedup,
    token_files,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_piece_encoding": piece_encoding.op3_piece_encoding,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_packing": packing.op7_packing,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_token_files": token_files.op9_token_files,
    "op10_pii": pii.op10_pii,
    "op11_substring_dedup": substring_dedup.op11_substring_dedup,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op6_quality_rules": quality.ORACLE,
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op11_substring_dedup": substring_dedup.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}
