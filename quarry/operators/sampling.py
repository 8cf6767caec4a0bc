"""Seeded, exact, stratified partitioning and class balancing (M1-M4, M6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ranking import hash_prefix_bucket, with_running_totals

MAX_CLASSES = 10_000


def row_hash(id_col: str, seed: int) -> Column:
    """Deterministic pseudo-random order key of a row: md5 of its id and the seed."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))


def class_counts(df: DataFrame, target: str) -> dict:
    """Rows per class; a target has few classes, and the count is checked before collecting."""
    counts = df.groupBy(target).count()
    rows = counts.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{target} has more than {MAX_CLASSES} classes; not a stratification target")
    return {r[target]: r["count"] for r in rows}


def rank_in_class(df: DataFrame, target: str, id_col: str, seed: int, out: str = "__rank") -> DataFrame:
    """Exact 1-based rank of each row inside its class in md5(id|seed) order (ties by id), and the
    class size in `<out>_total`.

    A class may hold most rows, so ranking is done per hash-prefix bucket of a class and offset
    by the counts of the earlier buckets (see `ranking`); the class sizes come from the same
    per-bucket table, so no separate counting job is needed.
    """
    h = "__h"
    work = df.withColumn(h, row_hash(id_col, seed))
    ranked = with_running_totals(work, h, {out: F.lit(1).cast("long")}, partition_cols=[target],
                                 tie_cols=[id_col], bucket=hash_prefix_bucket(F.col(h)), group_totals=True)
    return ranked.drop(h)


def stratified_split(df: DataFrame, target: str, id_col: str, ratios: Sequence[float] = (0.5,),
                     labels: Sequence[str] = ("train", "valid"), seed: int = 42,
                     out: str = "split") -> DataFrame:
    """Add a `split` label column: inside every class the first round(r1*n) rows of the hash
    order go to labels[0], the next round((r1+r2)*n) - round(r1*n) to labels[1], the rest to the
    last label. Shares are exact per class, as with a seeded stratified sample split.
    """
    if len(labels) != len(ratios) + 1:
        raise ValueError("need one label more than ratios")
    ranked = rank_in_class(df, target, id_col, seed)
    n_cls = F.col("__rank_total")
    rk = F.col("__rank")
    expr = None
    cum = 0.0
    for ratio, label in zip(ratios, labels):
        cum += ratio
        bound = F.floor(F.lit(cum) * n_cls + F.lit(0.5))
        expr = F.when(rk <= bound, F.lit(label)) if expr is None else expr.when(rk <= bound, F.lit(label))
    expr = expr.otherwise(F.lit(labels[-1]))
    return ranked.withColumn(out, expr).drop("__rank", "__rank_total")


def downsample(df: DataFrame, target: str, id_col: str, seed: int = 42,
               out: str | None = None) -> DataFrame:
    """Keep, in every class, the first `min class size` rows in hash order (majority down-sampled).

    With `out`, all rows are kept and `out` is a 0/1 membership flag instead. Rows without a class
    neither set the size nor enter the sample.
    """
    counts = class_counts(df, target)
    n_min = min((n for level, n in counts.items() if level is not None), default=0)
    ranked = rank_in_class(df, target, id_col, seed)
    keep = (F.col("__rank") <= F.lit(n_min)) & F.col(f"`{target}`").isNotNull()
    if out is None:
        return ranked.filter(keep).drop("__rank", "__rank_total")
    return ranked.withColumn(out, keep.cast("int")).drop("__rank", "__rank_total")


def inverse_prior_weights(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """Weight of a row = 1 / share of its class (the inverse-prior loss of a cost-sensitive fit)."""
    counts = class_counts(df, target)
    total = float(sum(counts.values()))
    pairs = []
    for k, v in counts.items():
        if k is not None:
            pairs += [F.lit(k), F.lit(total / v)]
    return df.withColumn(out, F.create_map(*pairs)[F.col(target)])
