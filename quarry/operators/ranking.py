"""Exact ordered running totals and ranks without a single-partition window.

A window ordered over a whole table (or over a two-class target) puts every row in one task.
Here rows are cut into value buckets that are monotone in the sort order; each bucket is ranked
by its own window task, and the totals of all earlier buckets are added from a small per-bucket
table. The result is exact and no task holds more than one bucket of one group.

A bucket is a function of the sort value, so callers pass (nearly) distinct sort values: unique
keys, md5 orders, or tables already collapsed to distinct values with counts. A value held by a
third of all rows is thus one row here, never one task's third of the data.
"""

from __future__ import annotations

import functools
import math
import os
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


ROWS_PER_BUCKET = 2_000_000
_BUCKET = "__bucket"


def hash_prefix_bucket(hex_col: Column, digits: int = 4) -> Column:
    """Bucket of a lowercase hex digest: its first `digits` characters as an integer.

    Monotone in the string order of the digest, and uniform, so no sampling pass is needed.
    """
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("long")


# Quantile grid of the first edge pass (one aggregate job). Data needing more buckets than this
# (over GRID * rows_per_bucket rows) gets a second, finer pass of at most MAX_BUCKETS edges.
_GRID = 1000
MAX_BUCKETS = 100_000


def _edges(df: DataFrame, value: Column, n_buckets: int, accuracy: int) -> list[float]:
    grid = [i / n_buckets for i in range(1, n_buckets)]
    q = df.agg(F.percentile_approx(value, grid, accuracy).alias("q")).first()["q"]
    return sorted(set(q or []))


def sort_number(df: DataFrame, col: str) -> Column:
    """A double that is non-decreasing in the sort order of `col`, for finding bucket edges only.

    Strings give the six bytes after the prefix that all their values share (one min/max aggregate).
    """
    c = F.col(f"`{col}`")
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if not isinstance(kind, T.StringType):
        return c.cast("double")
    ends = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    shared = os.path.commonprefix([(ends["lo"] or "").encode(), (ends["hi"] or "").encode()])
    digits = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), len(shared) + 1, 6)), 12, "0")
    return F.conv(digits, 16, 10).cast("double")


def quantile_bucket(df: DataFrame, col: str, rows_per_bucket: int = ROWS_PER_BUCKET,
                    accuracy: int = 10_000) -> tuple[DataFrame, int]:
    """Add an integer bucket column that is monotone in `col`, with about `rows_per_bucket` rows each.

    Row count and a grid of approximate quantiles come from one aggregate; edges are literals, so
    re-computation (e.g. after an executor loss) assigns the same buckets.
    """
    grid = [i / _GRID for i in range(1, _GRID)]
    value = sort_number(df, col)
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.percentile_approx(value, grid, accuracy).alias("q")).first()
    n = row["n"]
    wanted = max(1, math.ceil(n / rows_per_bucket))
    if wanted == 1 or row["q"] is None:
        return df.withColumn(_BUCKET, F.lit(0).cast("long")), 1
    if wanted <= _GRID:
        step = _GRID / wanted
        edges = sorted(set(row["q"][int(round(i * step)) - 1] for i in range(1, wanted)))
    else:
        b = min(wanted, MAX_BUCKETS)
        edges = _edges(df, value, b, 10 * b)
    splits = [-math.inf] + edges + [math.inf]
    src, tmp = _BUCKET + "_x", _BUCKET + "_d"
    out = Bucketizer(splits=splits, inputCol=src, outputCol=tmp, handleInvalid="keep").transform(
        df.withColumn(src, value))
    out = out.withColumn(_BUCKET, F.col(tmp).cast("long")).drop(src, tmp)
    return out, len(edges) + 1


def with_running_totals(df: DataFrame, order_col: str, sums: dict[str, Column],
                        partition_cols: Sequence[str] = (), tie_cols: Sequence[str] = (),
                        descending: bool = False, bucket: Column | None = None,
                        rows_per_bucket: int = ROWS_PER_BUCKET, group_totals: bool = False,
                        persist_input: bool = False) -> DataFrame:
    """Add inclusive running totals (`sums` name -> value expression) in the order of
    (`order_col`, `tie_cols`) inside `partition_cols` groups.

    `bucket`, when given, must be non-decreasing in `order_col`; otherwise one is derived from
    quantiles of `order_col`. A running total of ``F.lit(1)`` is the row number. With
    `group_totals`, `<name>_total` holds the group's grand total of each sum. `persist_input` keeps
    the input cached between the edge pass and the ranking: worth it for an aggregated input (which
    would be recomputed), not for a table scan (the edge pass reads only the pruned sort column).

    Plan: bucket totals are a map-side-combined aggregate (one row per non-empty bucket and group;
    Catalyst prunes that branch to the columns the sums need). Exclusive prefix sums over that small
    table are joined back on (group, bucket), the shuffle that also places rows for the ranking
    windows; AQE broadcasts the small side when its measured size allows. One path serves one bucket
    and many. No row is lost: NULL groups are groups, and rows with a NULL sort value form a bucket of
    their own, first in ascending order and last in descending order, as in Spark's own sort.
    """
    parts = list(partition_cols)
    if bucket is not None:
        work = df.withColumn(_BUCKET, bucket)
    else:
        src = df.persist(StorageLevel.MEMORY_AND_DISK) if persist_input else df
        work, _ = quantile_bucket(src, order_col, rows_per_bucket)
    work = work.withColumn(_BUCKET, F.when(F.col(f"`{order_col}`").isNull(), F.lit(-1)).otherwise(F.col(_BUCKET)))
    if descending:
        work = work.withColumn(_BUCKET, -F.col(_BUCKET))
    vals = {f"__v_{k}": v for k, v in sums.items()}
    work = work.select("*", *[v.alias(k) for k, v in vals.items()])

    keys = [*parts, _BUCKET]
    per_bucket = work.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*[F.sum(k).alias(k) for k in vals])
    wb = Window.partitionBy(*[F.col(f"`{k}`") for k in parts]).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    wg = Window.partitionBy(*[F.col(f"`{k}`") for k in parts])
    extra = [F.sum(k).over(wg).alias(f"{name}_total") for name, k in zip(sums, vals)] if group_totals else []
    offsets = per_bucket.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)],
                                *[F.coalesce(F.sum(k).over(wb), F.lit(0)).alias(f"{k}_off") for k in vals], *extra)
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    work = work.join(offsets, functools.reduce(lambda x, y: x & y, same)).drop(*[f"__k{i}" for i in range(len(keys))])

    order = [F.col(f"`{c}`").desc() if descending else F.col(f"`{c}`").asc() for c in (order_col, *tie_cols)]
    wr = (Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for name, k in zip(sums, vals):
        work = work.withColumn(name, F.sum(k).over(wr) + F.col(f"{k}_off"))
    return work.drop(_BUCKET, *vals, *[f"{k}_off" for k in vals])
