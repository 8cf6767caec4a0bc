"""Variable importance of each input against a target (V1-V6).

Each measure is one unpivot to (col_name, value, target) followed by grouped aggregates; the
result has one row per input column. p-values are added by a pandas UDF over those few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import pvalues
from quarry.operators.ranking import with_running_totals


def _long(df: DataFrame, cols: Sequence[str], target: str, value_type: str) -> DataFrame:
    return df.select(F.col(target).alias("y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(c).cast(value_type).alias("value")) for c in cols
    ])).alias("kv")).select("kv.col_name", "kv.value", "y")


def chi2_table(df: DataFrame, cols: Sequence[str], target: str, yates: bool = True) -> DataFrame:
    """Pearson chi-square of each nominal input against a nominal target (NULL levels dropped).

    Needs the observed cells only: sum (O - E)^2 / E = n * sum O^2 / (row * column) - n, in which empty
    cells add nothing, so neither a level list nor a zero-filled table is made. In 2x2 tables |O - E|
    is the same in all four cells, and the Yates correction min(0.5, |O - E|) is taken off it.
    """
    long = _long(df, cols, target, "string").filter(F.col("value").isNotNull() & F.col("y").isNotNull())
    cells = long.groupBy("col_name", "value", "y").agg(F.count(F.lit(1)).alias("o")).persist()
    n_classes = cells.agg(F.countDistinct("y")).first()[0]
    rows_ = cells.groupBy("col_name", "value").agg(F.sum("o").alias("rn"))
    cols_ = cells.groupBy("col_name", "y").agg(F.sum("o").alias("cn"))
    by_row = rows_.groupBy("col_name").agg(F.sum("rn").alias("n"), F.count(F.lit(1)).alias("r"),
                                           F.sum(F.lit(1.0) / F.col("rn")).alias("inv_r"))
    by_col = cols_.groupBy("col_name").agg(F.count(F.lit(1)).alias("k"), F.sum(F.lit(1.0) / F.col("cn")).alias("inv_c"))
    c = cells.join(rows_, ["col_name", "value"]).join(cols_, ["col_name", "y"]).join(by_row, "col_name")
    gap = F.abs(F.col("o") - F.col("rn") * F.col("cn") / F.col("n"))
    per = c.groupBy("col_name").agg(F.sum(F.col("o") * F.col("o") / (F.col("rn").cast("double") * F.col("cn"))).alias("s"),
                                    F.max(gap).alias("gap"))
    per = per.join(by_row, "col_name").join(by_col, "col_name")
    plain = F.col("n") * F.col("s") - F.col("n")
    fixed = F.pow(F.col("gap") - F.least(F.lit(0.5), F.col("gap")), 2) * F.col("n") * F.col("inv_r") * F.col("inv_c")
    stat = F.when((F.col("r") == 2) & (F.col("k") == 2) & F.lit(yates), fixed).otherwise(F.greatest(plain, F.lit(0.0)))
    return per.select("col_name", stat.alias("statistic"), ((F.col("r") - 1) * (n_classes - 1)).cast("long").alias("df"))


def welch_t(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Welch two-sample t of each numeric input between target classes 0 and 1: (col_name, t, df).
    An input without spread, or a missing class, gives NULL for that input only."""
    long = _long(df, cols, target, "double").filter(F.col("value").isNotNull())
    g = long.groupBy("col_name").agg(
        *[F.count(F.when(F.col("y") == k, F.col("value"))).alias(f"n{k}") for k in (0, 1)],
        *[F.avg(F.when(F.col("y") == k, F.col("value"))).alias(f"m{k}") for k in (0, 1)],
        *[F.var_samp(F.when(F.col("y") == k, F.col("value"))).alias(f"v{k}") for k in (0, 1)])
    a0 = F.try_divide(F.col("v0"), F.col("n0"))
    a1 = F.try_divide(F.col("v1"), F.col("n1"))
    t = F.try_divide(F.col("m0") - F.col("m1"), F.sqrt(a0 + a1))
    dof = F.try_divide(F.pow(a0 + a1, 2), F.try_divide(F.pow(a0, 2), F.col("n0") - 1) + F.try_divide(F.pow(a1, 2), F.col("n1") - 1))
    return g.select("col_name", t.alias("t"), dof.alias("df"))


def single_input_auc(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """AUC of each input used alone as a score (nominal inputs by alphabetical level code),
    reported as max(auc, 1 - auc). Exact with ties, via running totals per distinct value."""
    long = _long(df, cols, target, "double").filter(F.col("value").isNotNull())
    counts = long.groupBy("col_name", "value").agg(
        F.sum(F.col("y").cast("long")).alias("pos"), F.sum((1 - F.col("y")).cast("long")).alias("neg"))
    cum = with_running_totals(counts, "value", {"neg_le": F.col("neg")}, partition_cols=["col_name"],
                              persist_input=True)
    per = cum.groupBy("col_name").agg(
        F.sum(F.col("pos") * (F.col("neg_le") - F.col("neg") + F.col("neg") / 2.0)).alias("num"),
        F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    a = F.try_divide(F.col("num"), F.col("p") * F.col("n"))
    return per.select("col_name", F.greatest(a, 1 - a).alias("auc"))


def level_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace nominal columns by the 1-based alphabetical code of their level (level lists are small)."""
    from quarry.operators.explore import bounded_levels
    all_levels = bounded_levels(df, cols)
    out = df
    for c in cols:
        levels = all_levels[c]
        pairs = []
        for i, lv in enumerate(levels, start=1):
            pairs += [F.lit(lv), F.lit(float(i))]
        out = out.withColumn(c, F.create_map(*pairs)[F.col(c)])
    return out


def abs_correlation(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each input with a numeric target over complete pairs."""
    long = _long(df, cols, target, "double").filter(F.col("value").isNotNull() & F.col("y").isNotNull())
    # Written out, so that an input without spread gives NULL instead of a failing division.
    g = long.groupBy("col_name").agg(F.covar_samp("value", "y").alias("c"), F.stddev_samp("value").alias("sv"),
                                     F.stddev_samp("y").alias("sy"))
    g = g.select("col_name", F.try_divide(F.col("c"), F.col("sv") * F.col("sy")).alias("corr"))
    return g.select("col_name", "corr", F.abs("corr").alias("abs_corr"))


def anova_f(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """One-way ANOVA of a numeric target across the levels of each nominal input: (col_name, f, df1, df2)."""
    long = _long(df, cols, target, "string").filter(F.col("value").isNotNull() & F.col("y").isNotNull())
    grp = long.groupBy("col_name", "value").agg(
        F.count(F.lit(1)).alias("ng"), F.avg(F.col("y").cast("double")).alias("mg"),
        F.var_samp(F.col("y").cast("double")).alias("vg"))
    # Sum of squares between groups from the group table alone: the variance of n copies of each mean.
    tot = grp.groupBy("col_name").agg(F.sum("ng").alias("n"), (F.sum(F.col("ng") * F.col("mg")) / F.sum("ng")).alias("m"))
    j = grp.join(tot, "col_name")
    per = j.groupBy("col_name").agg(
        F.sum(F.col("ng") * F.pow(F.col("mg") - F.col("m"), 2)).alias("ssb"),
        F.sum(F.coalesce((F.col("ng") - 1) * F.col("vg"), F.lit(0.0))).alias("ssw"),
        F.count(F.lit(1)).alias("k"), F.first("n").alias("n"))
    df1 = F.col("k") - 1
    df2 = F.col("n") - F.col("k")
    return per.select("col_name", F.try_divide(F.try_divide(F.col("ssb"), df1), F.try_divide(F.col("ssw"), df2)).alias("f"),
                      df1.cast("long").alias("df1"), df2.cast("long").alias("df2"))


def binned_r2(df: DataFrame, cols: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Non-parametric R^2 of a numeric target on each input: the target's conditional mean over
    exact quantile bins of the input (bin = number of decile edges below x); R^2 = 1 - SSW / SST."""
    from quarry.operators.explore import quantile_table
    probs = [i / bins for i in range(1, bins)]
    edges = quantile_table(df, cols, probs).collect()   # (bins - 1) edges per column
    by_col: dict[str, list] = {}
    for r in sorted(edges, key=lambda r: r["p"]):
        by_col.setdefault(r["col_name"], []).append(r["q"])
    long = _long(df, cols, target, "double").filter(F.col("value").isNotNull() & F.col("y").isNotNull())
    bin_expr = None
    for c in cols:
        e = F.lit(0)
        for q in by_col.get(c, []):
            e = e + (F.col("value") > F.lit(q)).cast("int")
        bin_expr = F.when(F.col("col_name") == c, e) if bin_expr is None else bin_expr.when(F.col("col_name") == c, e)
    b = long.withColumn("bin", bin_expr)
    grp = b.groupBy("col_name", "bin").agg(F.count(F.lit(1)).alias("nb"), F.var_samp("y").alias("vb"))
    ssw = grp.groupBy("col_name").agg(F.sum(F.coalesce((F.col("nb") - 1) * F.col("vb"), F.lit(0.0))).alias("ssw"))
    sst = b.groupBy("col_name").agg(((F.count(F.lit(1)) - 1) * F.var_samp("y")).alias("sst"))
    return ssw.join(sst, "col_name").select("col_name", (1 - F.try_divide(F.col("ssw"), F.col("sst"))).alias("r2"))


@F.pandas_udf(T.DoubleType())
def chi2_p(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([pvalues.chi2_sf(s, d) for s, d in zip(stat, dof)])


@F.pandas_udf(T.DoubleType())
def t_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([pvalues.t_two_sided(a, d) for a, d in zip(t, dof)])


@F.pandas_udf(T.DoubleType())
def f_p(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return pd.Series([pvalues.f_sf(a, b, c) for a, b, c in zip(f, df1, df2)])
