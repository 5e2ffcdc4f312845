"""All queries of this library outside the llm package, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamwork.plans import collecting, corpus, decisions, labelling, operations, relational, scores

_MODULES = (collecting, corpus, labelling, relational, scores, decisions, operations)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for module in _MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
