"""Registered queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymart.catalog import (  # noqa: F401  (import registers)
    cleaning,
    mutation,
    profiling,
    quality_rules,
    relational,
    reports,
    sources_sinks,
    windows,
)
from tallymart.catalog.registry import ORACLES, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
