"""The queries of this package and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamwork.llm import bpe, elkan, license_scan, line_dedup, order_minhash, packing, phrases, piece_bpe, pii, quality_classifier, quality_rules, simhash_dedup, substring_dedup

_MODULES = (bpe, elkan, license_scan, line_dedup, order_minhash, packing, phrases, piece_bpe, pii, quality_classifier, quality_rules, simhash_dedup, substring_dedup)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for module in _MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
