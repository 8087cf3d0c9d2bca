"""The queries of the library and the SQL each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.plans import code_queries, coverage_queries, more_queries, price_queries  # noqa: F401 - all add to one table


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(price_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(price_queries.SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation of two price readings, judged by supplier."""
    return price_queries.QUERIES["reconcile_suppliers"](spark, sf_dir)
