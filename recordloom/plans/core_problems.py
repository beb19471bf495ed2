"""Queries of the general problem that belongs to the core: values packed in one field."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordloom.operators.packed_fields import split_packed
from recordloom.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, field, pos, item): each value of `data_source` and `notes`."""
    return split_packed(table(spark, sf_dir, "fighters"), "id", ["data_source", "notes"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p2_found": p2_found}
ORACLES: dict[str, str] = {}
