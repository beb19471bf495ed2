"""All queries of the core with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordloom.plans import classify_queries, core_problems, history_queries, ladder_queries, matching_queries, merge_queries, page_queries, scalar_queries

_MODULES = (core_problems, scalar_queries, classify_queries, page_queries, matching_queries, ladder_queries, merge_queries, history_queries)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core_problems.p2_found(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
