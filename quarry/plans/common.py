"""Helpers shared by the plan modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.plans.fixtures import MINING_ORDERS_SQL, SCORED_ORDERS_SQL, mining_orders, scored_orders

__all__ = ["mo", "so", "with_mo", "with_so", "DIGITS"]

DIGITS = 6


def mo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining_orders(spark, sf_dir)


def so(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_orders(spark, sf_dir)


def with_mo(sql: str) -> str:
    """Prefix a query body with the `mining_orders` CTE (the body may add `, name AS (...)`)."""
    return "WITH " + MINING_ORDERS_SQL + sql


def with_so(sql: str) -> str:
    return "WITH " + SCORED_ORDERS_SQL + sql
