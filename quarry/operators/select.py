"""Projection and row selection (P-series)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, BooleanType

from quarry.functions.columns import named
from quarry.operators.ranking import with_running_totals


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """Names matched by a regex searched from the start of the name (prefix unless `$` is given)."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.search(c)]


def select_by_regex(df: DataFrame, pattern: str, reject: bool = False,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Select (or, with reject, drop) the columns matching `pattern`; `keep` restores named columns."""
    hit = set(columns_matching(df, pattern))
    chosen = [c for c in df.columns if (c not in hit) == reject or c in keep]
    return df.select(*map(named, chosen))


def select_by_position(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """1-based positions, as `df[c(1,2,3)]`."""
    return df.select(*[named(df.columns[i - 1]) for i in positions])


def drop_by_position(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Drop 1-based positions, as `df[-c(1,3)]`."""
    return df.drop(*[df.columns[i - 1] for i in positions])


def columns_of_kind(df: DataFrame, kind: str, exclude: Sequence[str] = ()) -> list[str]:
    """'numeric' or 'nominal' (string/boolean) columns, minus `exclude`."""
    out = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        numeric = isinstance(f.dataType, NumericType)
        nominal = isinstance(f.dataType, (StringType, BooleanType))
        if (kind == "numeric" and numeric) or (kind == "nominal" and nominal):
            out.append(f.name)
    return out


def with_row_index(df: DataFrame, key: str, out: str = "row_idx") -> DataFrame:
    """1-based row position in the order of an explicit key (exact, no single-partition window)."""
    return with_running_totals(df, key, {out: F.lit(1).cast("long")})


def row_slice(df: DataFrame, key: str, lo: int, hi: int, exclude: bool = False) -> DataFrame:
    """Rows lo..hi (1-based, inclusive) in key order (NULL keys first), or all other rows when
    `exclude`, by the exact bucketed ranking of the whole table."""
    idx = with_row_index(df, key)
    inside = F.col("row_idx").between(lo, hi)
    return idx.filter(~inside if exclude else inside)


def which_rows(df: DataFrame, cond: Column, key: str) -> DataFrame:
    """Positions (row_idx) of the rows meeting `cond`."""
    return with_row_index(df, key).filter(cond).select("row_idx")


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with no NULL in `cols`. Written as IS NOT NULL predicates (not `dropna`, whose
    at-least-n-non-nulls test is not pushed to the Parquet scan) so the filter reaches the files."""
    cond = None
    for c in cols:
        cond = named(c).isNotNull() if cond is None else cond & named(c).isNotNull()
    return df.filter(cond)


def member_flag(df: DataFrame, other: DataFrame, key: str, out: str = "member") -> DataFrame:
    """1 when the row's key occurs in `other` (left join on the distinct keys of `other`).

    A plain join: the sample grows with the data, and AQE broadcasts it only if its bytes allow.
    """
    keys = other.select(named(key).alias("__k")).distinct().withColumn("__hit", F.lit(1))
    j = df.join(keys, named(key) == F.col("__k"), "left")
    return j.withColumn(out, F.coalesce(F.col("__hit"), F.lit(0))).drop("__k", "__hit")


def semi_member(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in `other` (left semi join)."""
    return df.join(other.select(key), key, "left_semi")


def role_profile(df: DataFrame, non_input_pattern: str) -> DataFrame:
    """Per column: numeric input, nominal input, has NULLs; non-inputs forced false. One aggregate."""
    non_inputs = set(columns_matching(df, non_input_pattern))
    kinds = {f.name: (isinstance(f.dataType, NumericType), isinstance(f.dataType, (StringType, BooleanType)))
             for f in df.schema.fields}
    row = df.agg(*[F.max(named(c).isNull()).alias(c) for c in df.columns]).first()
    rows = []
    for pos, c in enumerate(df.columns, start=1):
        inp = c not in non_inputs
        rows.append((pos, c, inp and kinds[c][0], inp and kinds[c][1], inp and bool(row[c])))
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, numeric boolean, nominal boolean, missing boolean")
