"""Joins in which NULL is a key value like any other (a class of its own)."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join (inner or left) on `keys` with NULL equal to NULL; the keys come out once, from the left."""
    names = {k: f"__r_{i}" for i, k in enumerate(keys)}
    other = right.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in right.columns])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()]
    return left.join(other, functools.reduce(lambda a, b: a & b, same), how).drop(*names.values())
