"""Registry of named queries (callables of (spark, sf_dir)) and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Plan modules, each exporting QUERIES: dict[name, callable] and ORACLE: dict[name, sql].
PLAN_MODULES = [
    "quarry.plans.q_core",
    "quarry.plans.q_select",
    "quarry.plans.q_transform",
    "quarry.plans.q_explore",
    "quarry.plans.q_evaluate",
    "quarry.plans.q_importance",
    "quarry.plans.q_basket",
    "quarry.plans.q_cluster",
    "quarry.plans.q_models",
    "quarry.plans.q_io",
    "quarry.plans.q_more",
]


def _load():
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    oracle: dict[str, str] = {}
    for mod_name in PLAN_MODULES:
        mod = importlib.import_module(mod_name)
        for k, v in mod.QUERIES.items():
            if k in queries:
                raise ValueError(f"duplicate query {k}")
            queries[k] = v
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _load()[0]


def oracle_sql() -> dict[str, str]:
    return _load()[1]
