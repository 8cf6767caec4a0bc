"""Column transforms (T-series): parsing, recoding, log, flags, scaling, dummies, power fits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.functions.columns import named

FLAG_SUFFIX = "_NA"


def missing_flag_columns(df: DataFrame, cols: Sequence[str], where=None) -> list[str]:
    """Columns (among `cols`) with at least one NULL, decided once at fit time: one aggregate."""
    src = df if where is None else df.filter(where)
    row = src.agg(*[F.max(named(c).isNull().cast("int")).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] == 1]


def add_missing_flags(df: DataFrame, cols: Sequence[str], suffix: str = FLAG_SUFFIX) -> DataFrame:
    """`<col>_NA` = 1 when the column is NULL, for a persisted list of columns."""
    return df.select("*", *[named(c).isNull().cast("int").alias(c + suffix) for c in cols])


def log1p_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """log(x + 1) in place for the given columns."""
    cols = set(cols)
    return df.select(*[F.log1p(named(c)).alias(c) if c in cols else named(c) for c in df.columns])


def recode(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """Relabel/collapse levels by an explicit old -> new map; unseen levels -> NULL."""
    return df.withColumn(out or col, fc.level_map(col, mapping))


def standardize(df: DataFrame, cols: Sequence[str], where=None, suffix: str = "") -> tuple[DataFrame, dict]:
    """(x - mean) / sd with mean and sample sd from (optionally filtered) rows; one aggregate. A column
    without spread has no standard scores: NULL."""
    src = df if where is None else df.filter(where)
    aggs = []
    for c in cols:
        aggs += [F.avg(named(c)).alias(f"m_{c}"), F.stddev_samp(named(c)).alias(f"s_{c}")]
    row = src.agg(*aggs).first()
    params = {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}
    out = df
    for c in cols:
        m, s = params[c]
        out = out.withColumn(c + suffix, F.try_divide(named(c) - F.lit(m), F.lit(s).cast("double")))
    return out, params


# Power-transform grid (fixed values): lambda from -2 to 2 in steps of 0.1.
LAMBDA_GRID = [round(-2.0 + 0.1 * i, 1) for i in range(41)]


# Powers are taken as exp(lambda * log(base)) with the log computed once per row: the JVM's pow
# is several times slower and the grid evaluates 41 powers per value.
def _boxcox(lx, lam):
    """Box-Cox of x given lx = log(x)."""
    return F.when(lam == 0, lx).otherwise((F.exp(lam * lx) - F.lit(1.0)) / lam)


def _yeojohnson(x, lam):
    lp, ln_ = F.log1p(x), F.log1p(-x)
    pos = F.when(lam == 0, lp).otherwise((F.exp(lam * lp) - F.lit(1.0)) / lam)
    neg = F.when(lam == 2, -ln_).otherwise(-(F.exp((F.lit(2.0) - lam) * ln_) - F.lit(1.0)) / (F.lit(2.0) - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def power_profile(df: DataFrame, cols: Sequence[str], method: str = "boxcox",
                  grid: Sequence[float] = LAMBDA_GRID) -> DataFrame:
    """Profile log-likelihood of a power transform on a lambda grid: (col_name, lambda, n, loglik).

    loglik(l) = -n/2 * log(var_pop(y_l)) + (l - 1) * J, with J = sum(log x) (Box-Cox, x > 0 only)
    or sum(sign(x) * log(|x| + 1)) (Yeo-Johnson). Rows are expanded to (column, lambda) pairs and
    aggregated by that key: a compact, code-generated aggregate combined map-side, whose shuffle
    carries one row per (column, lambda) and partition.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), named(c).cast("double").alias("x")) for c in cols
    ])).alias("e")).select("e.col_name", "e.x").filter(F.col("x").isNotNull())
    if method == "boxcox":
        long = long.filter(F.col("x") > 0).withColumn("x", F.log(F.col("x")))   # carry log(x)
        jac = F.col("x")
    else:
        jac = F.signum(F.col("x")) * F.log1p(F.abs(F.col("x")))
    pairs = long.select("col_name", "x", jac.alias("jac"),
                        F.explode(F.array(*[F.lit(float(lam)) for lam in grid])).alias("lambda"))
    lam = F.col("lambda")
    y = _boxcox(F.col("x"), lam) if method == "boxcox" else _yeojohnson(F.col("x"), lam)
    agg = pairs.groupBy("col_name", "lambda").agg(F.count(F.lit(1)).alias("n"), F.var_pop(y).alias("v"),
                                                  F.sum("jac").alias("j"))
    return agg.select("col_name", "lambda", "n",
                      (-F.col("n") / 2.0 * F.log(F.col("v")) + (F.col("lambda") - 1.0) * F.col("j")).alias("loglik"))


def refined_lambda(df: DataFrame, cols: Sequence[str], method: str = "yeojohnson",
                   step: float = 0.01, half_width: float = 0.1) -> DataFrame:
    """Grid fit, then one refinement pass on a finer grid around each column's best lambda.

    Both passes are the same keyed aggregate; the second uses per-column literal grids
    (best +- half_width in `step`s) chosen from the first pass's small result.
    """
    coarse = {r["col_name"]: r["lambda"] for r in best_lambda(power_profile(df, cols, method)).collect()}
    k = int(round(half_width / step))
    parts = []
    for c in cols:
        lam0 = coarse[c]
        grid = [round(lam0 + step * i, 6) for i in range(-k, k + 1)]
        parts.append(best_lambda(power_profile(df, [c], method, grid)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def best_lambda(profile: DataFrame) -> DataFrame:
    """Lambda of the highest profile log-likelihood per column (ties -> smaller lambda)."""
    return profile.groupBy("col_name").agg(
        F.max_by("lambda", F.struct(F.col("loglik"), -F.col("lambda"))).alias("lambda"),
        F.max("loglik").alias("loglik"), F.first("n").alias("n"))


def dummy_levels(df: DataFrame, cols: Sequence[str], where=None) -> dict[str, list]:
    """Sorted distinct non-NULL levels per nominal column (fit-time state; bounded level count)."""
    from quarry.operators.explore import bounded_levels
    src = df if where is None else df.filter(where)
    return bounded_levels(src, cols)


def dummy_name(column: str, level) -> str:
    """Name of a level's indicator column; dots, which model stages can't have, become two underscores."""
    return f"{column}_{level}".replace(".", "__")


def add_dummies(df: DataFrame, levels: dict[str, list], full_rank: bool = True) -> DataFrame:
    """Indicator columns `<col>_<level>`; full rank drops the first level. NULL stays NULL."""
    exprs = []
    for c, lv in levels.items():
        for level in (lv[1:] if full_rank else lv):
            exprs.append(F.when(named(c).isNull(), F.lit(None).cast("int"))
                         .when(named(c) == F.lit(level), 1).otherwise(0).alias(dummy_name(c, level)))
    return df.select("*", *exprs)


def products(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Interaction (a*b) and square (a*a) terms named `a_x_b`."""
    return df.select("*", *[(named(a) * named(b)).alias(f"{a}_x_{b}") for a, b in pairs])


def all_pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    cols = list(cols)
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


def relevel(levels: Sequence, reference) -> list:
    """Level list with `reference` moved to the front (the reference level of a nominal input)."""
    return [reference] + [lv for lv in levels if lv != reference]


def reverse_levels(levels: Sequence) -> list:
    """Reverse level order (event first)."""
    return list(reversed(list(levels)))


def apply_boxcox(df: DataFrame, lambdas: Mapping[str, float]) -> DataFrame:
    """Fitted Box-Cox powers in place; values that are not positive have no power and become NULL."""
    def power(c: str):
        x = named(c).cast("double")
        return F.when(x > 0, _boxcox(F.log(x), F.lit(float(lambdas[c]))))
    return df.select(*[power(c).alias(c) if c in lambdas else named(c) for c in df.columns])


def apply_yeojohnson(df: DataFrame, lambdas: Mapping[str, float]) -> DataFrame:
    """Fitted Yeo-Johnson powers in place."""
    return df.select(*[_yeojohnson(named(c).cast("double"), F.lit(float(lambdas[c]))).alias(c) if c in lambdas else named(c)
                       for c in df.columns])
