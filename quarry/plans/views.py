"""Derived views written once per session as Parquet tables in the shared checkpoint folder.

A prepared modelling table is read by many analyses; writing it once turns every later use into
a pruned, filter-pushed Parquet scan and cuts the lineage (a lost executor re-reads files instead
of recomputing joins and aggregates).
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.session import ensure_checkpoint_dir

_LOCK = threading.Lock()
_PATHS: dict[tuple[str, str, str], str] = {}


def materialized(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, name, sf_dir)
    with _LOCK:
        path = _PATHS.get(key)
        if path is None:
            path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/views/{name}-{uuid.uuid4().hex}"
            build().write.mode("overwrite").parquet(path)
            _PATHS[key] = path
    return spark.read.parquet(path)
