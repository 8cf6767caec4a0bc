"""Imputation with statistics learned on training rows and applied by column name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import named


def fit_means(df: DataFrame, cols: Sequence[str], where: Column | None = None) -> dict[str, float]:
    """Column means over (optionally filtered) rows, NULLs ignored: one aggregate job."""
    src = df if where is None else df.filter(where)
    row = src.agg(*[F.avg(named(c)).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fit_medians(df: DataFrame, cols: Sequence[str], where: Column | None = None) -> dict[str, float]:
    """Exact medians (type-7 interpolation) via the distributed quantile operator."""
    from quarry.operators.explore import exact_quantiles
    src = df if where is None else df.filter(where)
    q = exact_quantiles(src, cols, [0.5])
    return {c: q[c][0] for c in cols}


def fit_modes(df: DataFrame, cols: Sequence[str], where: Column | None = None) -> dict:
    """Most frequent non-NULL value per column; ties -> smallest value.

    Columns are unpivoted to (column, value) and counted with map-side partial aggregation, so a
    value held by most rows is combined before the shuffle. Only one row per column reaches the driver.
    """
    src = df if where is None else df.filter(where)
    stacked = src.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.column", "kv.value").filter(F.col("value").isNotNull())
    counts = stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("mode"))
    got = {r["column"]: r["mode"] for r in best.collect()}
    types = dict(df.dtypes)
    out = {}
    for c in cols:
        v = got.get(c)
        out[c] = _cast_back(v, types[c])
    return out


def _cast_back(v, dtype: str):
    if v is None:
        return None
    if dtype in ("int", "bigint", "smallint", "tinyint"):
        return int(v)
    if dtype in ("double", "float") or dtype.startswith("decimal"):
        return float(v)
    return v


def apply_fill(df: DataFrame, values: dict) -> DataFrame:
    """Replace NULLs by stored values, matched by column name (not position)."""
    exprs = []
    for c in df.columns:
        if c in values and values[c] is not None:
            v = values[c]
            if isinstance(v, float):
                exprs.append(F.coalesce(named(c).cast("double"), F.lit(v)).alias(c))
            else:
                exprs.append(F.coalesce(named(c), F.lit(v).cast(dict(df.dtypes)[c])).alias(c))
        else:
            exprs.append(named(c))
    return df.select(*exprs)
