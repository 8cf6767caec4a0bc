"""Exploration aggregates (A-series): summaries, moments, quantiles, frequencies, histograms,
contingency tables, class profiles and ranked extremes.

Numeric statistics are wide single-pass aggregates. Exact quantiles collapse each column to its
distinct values with counts (combined map-side), take exact running counts per value bucket, and
pick the type-7 order statistics: no group is ever sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import named
from quarry.operators.joins import join_null_safe
from quarry.operators.ranking import with_running_totals

# Most levels a nominal column may have when its level list is brought to the driver.
MAX_LEVELS = 10_000


def unpivot_values(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = (),
                   value_type: str = "double") -> DataFrame:
    """(group..., col_name, value) rows for the given columns (NULL values kept)."""
    return df.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), named(c).cast(value_type).alias("value")) for c in cols
    ])).alias("__kv")).select(*group_cols, "__kv.col_name", "__kv.value")


def value_counts(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = (),
                 value_type: str = "double") -> DataFrame:
    """Distinct non-NULL (group..., col_name, value) with their counts `cnt`."""
    long = unpivot_values(df, cols, group_cols, value_type).filter(F.col("value").isNotNull())
    return long.groupBy(*group_cols, "col_name", "value").agg(F.count(F.lit(1)).alias("cnt"))


def cumulative_counts(long: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """From (group..., col_name, value) rows: distinct values with `cnt`, inclusive running count
    `__cum` in value order and the group size `__n` (one ranking pass; see `ranking`)."""
    keys = [*group_cols, "col_name"]
    vc = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("cnt"))
    cum = with_running_totals(vc, "value", {"__cum": F.col("cnt")}, partition_cols=keys, group_totals=True,
                              persist_input=True)
    return cum.withColumnRenamed("__cum_total", "__n")


def quantiles_from_counts(cum: DataFrame, probs: Sequence[float], group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact type-7 quantiles (group..., col_name, p, q) from a `cumulative_counts` table."""
    keys = [*group_cols, "col_name"]
    h = (F.col("__n") - 1) * F.col("p") + 1
    ranks = cum.select(*keys, "value", "cnt", "__cum", "__n",
                       F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
    ranks = ranks.withColumn("__lo", F.floor(h)).withColumn("__hi", F.ceil(h)).withColumn("__h", h)
    first = F.col("__cum") - F.col("cnt") + 1
    hit_lo = (first <= F.col("__lo")) & (F.col("__lo") <= F.col("__cum"))
    hit_hi = (first <= F.col("__hi")) & (F.col("__hi") <= F.col("__cum"))
    picked = ranks.filter(hit_lo | hit_hi).groupBy(*keys, "p").agg(
        F.max(F.when(hit_lo, F.col("value"))).alias("x_lo"),
        F.max(F.when(hit_hi, F.col("value"))).alias("x_hi"),
        F.first("__h").alias("h"), F.first("__lo").alias("lo"))
    q = F.col("x_lo") + (F.col("h") - F.col("lo")) * (F.col("x_hi") - F.col("x_lo"))
    return picked.select(*keys, "p", q.alias("q"))


def trimmed_from_counts(cum: DataFrame, trim: float, group_cols: Sequence[str] = ()) -> DataFrame:
    """Trimmed mean (drop floor(trim*n) values at each end) from a `cumulative_counts` table: equal
    values are weighted by their overlap with the kept rank range."""
    keys = [*group_cols, "col_name"]
    k = F.floor(F.col("__n") * trim)
    lo, hi = k + 1, F.col("__n") - k
    first = F.col("__cum") - F.col("cnt") + 1
    overlap = F.greatest(F.least(F.col("__cum"), hi) - F.greatest(first, lo) + 1, F.lit(0))
    return cum.groupBy(*keys).agg((F.sum(F.col("value") * overlap) / F.sum(overlap)).alias("trimmed_mean"))


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact type-7 quantiles: (group..., col_name, p, q), NULLs ignored."""
    long = unpivot_values(df, cols, group_cols).filter(F.col("value").isNotNull())
    return quantiles_from_counts(cumulative_counts(long, group_cols), probs, group_cols)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list]:
    """Driver dict col -> [q(p) for p in probs]; only len(cols)*len(probs) rows are collected."""
    rows = quantile_table(df, cols, probs).collect()
    got = {(r["col_name"], r["p"]): r["q"] for r in rows}
    return {c: [got.get((c, float(p))) for p in probs] for c in cols}


def numeric_summary(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = (),
                    digits: int = 6) -> DataFrame:
    """Six-number summary + NA count per column (and group): min, q1, median, mean, q3, max, n_na."""
    keys = [*group_cols, "col_name"]
    long = unpivot_values(df, cols, group_cols)
    basic = long.groupBy(*keys).agg(
        F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max"),
        F.count_if(F.col("value").isNull()).alias("n_na"))
    qt = quantile_table(df, cols, [0.25, 0.5, 0.75], group_cols)
    wide = qt.groupBy(*keys).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    out = join_null_safe(basic, wide, keys, "left")
    return out.select(*keys, *[F.round(c, digits).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")],
                      "n_na")


def level_counts(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., col_name, level, n) including the NULL level: nominal part of a summary."""
    long = unpivot_values(df, cols, group_cols, value_type="string")
    return long.groupBy(*group_cols, "col_name", F.col("value").alias("level")).agg(
        F.count(F.lit(1)).alias("n"))


def moments(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Per column: n, NAs, sum, mean, var, sd, skewness and excess kurtosis (sample-sd forms).

    Spark's skewness/kurtosis use population moments; the sample-sd versions are
    g1 * ((n-1)/n)^1.5 and (g2 + 3) * ((n-1)/n)^2 - 3.
    """
    keys = [*group_cols, "col_name"]
    long = unpivot_values(df, cols, group_cols)
    v = F.col("value")
    agg = long.groupBy(*keys).agg(
        F.count(v).alias("n"), F.count_if(v.isNull()).alias("n_na"), F.sum(v).alias("sum"),
        F.avg(v).alias("mean"), F.var_samp(v).alias("var"), F.stddev_samp(v).alias("sd"),
        F.skewness(v).alias("g1"), F.kurtosis(v).alias("g2"), F.min(v).alias("min"), F.max(v).alias("max"))
    n = F.col("n").cast("double")
    r = (n - 1) / n
    return agg.select(*keys, "n", "n_na", "min", "max", "sum", "mean", "var", "sd",
                      (F.col("sd") / F.sqrt(n)).alias("se"),
                      (F.col("g1") * F.pow(r, 1.5)).alias("skew"),
                      ((F.col("g2") + 3) * F.pow(r, 2.0) - 3).alias("kurt"))


def missing_fraction(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(col_name, frac_missing) sorted descending; one aggregate over all columns."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.avg(named(c).isNull().cast("double")).alias(c) for c in cols])
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(f"`{c}`").alias("frac_missing")) for c in cols
    ])).alias("e")).select("e.*")
    return long.orderBy(F.desc("frac_missing"), "col_name")


def missing_map(df: DataFrame, key: str, block_rows: int, cols: Sequence[str] | None = None) -> DataFrame:
    """Data behind a missingness map: NULL count per (block of `block_rows` rows in key order, column)."""
    from quarry.operators.select import with_row_index
    cols = [c for c in (cols or df.columns) if c != key]
    idx = with_row_index(df.select(key, *cols), key)
    block = F.floor((F.col("row_idx") - 1) / block_rows).alias("row_block")
    long = idx.select(block, F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), named(c).isNull().cast("int").alias("na")) for c in cols
    ])).alias("e")).select("row_block", "e.col_name", "e.na")
    return long.groupBy("row_block", "col_name").agg(F.sum("na").alias("n_missing"),
                                                    F.count(F.lit(1)).alias("n_rows"))


def freq_desc(df: DataFrame, col: str) -> DataFrame:
    """Frequency table of a nominal column, most frequent first (ties by level)."""
    return df.groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.asc_nulls_last("level"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int) -> DataFrame:
    """Equal-width bins over [min, max] per column, right-closed with the lowest value in bin 1.

    (col_name, bin, lo, hi, n). Min/max come from one aggregate; binning is a narrow projection
    followed by a map-side-combined count.
    """
    long = unpivot_values(df, cols).filter(F.col("value").isNotNull())
    rng = long.groupBy("col_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = long.join(F.broadcast(rng), "col_name")  # one row per column: bounded by the column count
    w = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), 1).otherwise(
        F.least(F.greatest(F.ceil((F.col("value") - F.col("lo")) / w), F.lit(1)), F.lit(bins)))
    counted = j.select("col_name", b.cast("int").alias("bin"), "lo", "hi").groupBy("col_name", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("lo").alias("_lo"), F.first("hi").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return counted.select("col_name", "bin",
                          (F.col("_lo") + (F.col("bin") - 1) * width).alias("lo"),
                          (F.col("_lo") + F.col("bin") * width).alias("hi"), "n")


def contingency(df: DataFrame, a: str, b: str, zero_fill: bool = True) -> DataFrame:
    """Two-way counts (a, b, n); with zero_fill every observed level pair appears (n may be 0).

    Zero filling pivots the (small) count table on the levels of `b` and unpivots it again, so
    no level product is ever joined.
    """
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    if not zero_fill:
        return counts
    levels_b = [r[0] for r in counts.select(b).distinct().limit(MAX_LEVELS + 1).collect()]
    if len(levels_b) > MAX_LEVELS:
        raise ValueError(f"{b} has more than {MAX_LEVELS} levels")
    tag = {lv: f"__l{i}" for i, lv in enumerate(levels_b)}
    wide = counts.groupBy(a).pivot(b, levels_b).agg(F.sum("n"))
    wide = wide.toDF(a, *[tag[lv] for lv in levels_b])
    pairs = F.array(*[F.struct(F.lit(lv).cast(dict(counts.dtypes)[b]).alias(b),
                               F.coalesce(F.col(tag[lv]), F.lit(0)).cast("long").alias("n")) for lv in levels_b])
    return wide.select(a, F.explode(pairs).alias("e")).select(a, f"e.{b}", "e.n")


def crosstable(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cells with row, column and total shares and the chi-square contribution of each cell.

    Margins are window sums over the cell table, whose size is the product of level counts.
    """
    cells = contingency(df, a, b)
    j = cells.select("*", F.sum("n").over(Window.partitionBy(a)).alias("row_n"),
                     F.sum("n").over(Window.partitionBy(b)).alias("col_n"),
                     cells.select(F.sum("n")).scalar().alias("total"))
    exp_ = F.col("row_n") * F.col("col_n") / F.col("total")
    return j.select(a, b, "n",
                    (F.col("n") / F.col("row_n")).alias("row_share"),
                    (F.col("n") / F.col("col_n")).alias("col_share"),
                    (F.col("n") / F.col("total")).alias("total_share"),
                    (F.pow(F.col("n") - exp_, 2) / exp_).alias("chi2_contrib"))


def class_shares(df: DataFrame, col: str) -> DataFrame:
    """(level, n, share, inverse_prior) for a class column (the count table has one row per class)."""
    counts = df.groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.select("level", "n", (F.col("n") / total).alias("share"),
                         (total / F.col("n")).alias("inverse_prior"))


def trimmed_mean_mad(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = (),
                     trim: float = 0.1, cum: DataFrame | None = None) -> DataFrame:
    """Per (group, column): trimmed mean, median and mad = 1.4826 * median |x - median|.

    One cumulative value-count table serves the trim and the median (pass `cum` to share it with
    other quantiles); the deviations from the median need a second one.
    """
    keys = [*group_cols, "col_name"]
    long = unpivot_values(df, cols, group_cols).filter(F.col("value").isNotNull())
    if cum is None:
        cum = cumulative_counts(long, group_cols)
    tmean = trimmed_from_counts(cum, trim, group_cols)
    med = quantiles_from_counts(cum, [0.5], group_cols).select(*keys, F.col("q").alias("__med"))
    # One median per (group, column): AQE broadcasts it when small, shuffles it otherwise.
    dev = join_null_safe(long, med, keys).select(*group_cols, "col_name",
                                                   F.abs(F.col("value") - F.col("__med")).alias("value"))
    mad = quantiles_from_counts(cumulative_counts(dev, group_cols), [0.5], group_cols).select(
        *keys, (F.col("q") * 1.4826).alias("mad"))
    return join_null_safe(join_null_safe(tmean, med.withColumnRenamed("__med", "median"), keys), mad, keys, "left")


def top_n(df: DataFrame, measure: str, n: int, key: str, descending: bool = True) -> DataFrame:
    """Top-N rows of a measure with a key tie-break (TakeOrdered: each task keeps only n rows)."""
    order = [F.desc(measure) if descending else F.asc(measure), F.asc(key)]
    return df.orderBy(*order).limit(n)


def arg_extremes(df: DataFrame, measure: str, key: str) -> DataFrame:
    """max, key of max, min, key of min (ties -> smallest key): one aggregate."""
    m = F.col(measure)
    return df.agg(F.max(m).alias("max_value"),
                  F.max_by(key, F.struct(m, -F.col(key))).alias("argmax_key"),
                  F.min(m).alias("min_value"),
                  F.min_by(key, F.struct(m, F.col(key))).alias("argmin_key"))


def bounded_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list]:
    """Sorted distinct non-NULL levels per nominal column, from one distributed distinct.

    At most `max_levels` levels per column may reach the driver; a column with more is not a
    nominal input and raises instead of pulling an unbounded list.
    """
    long = unpivot_values(df, cols, value_type="string").filter(F.col("value").isNotNull()).distinct()
    per = long.groupBy("col_name").agg(F.count(F.lit(1)).alias("n"))
    too_many = per.filter(F.col("n") > max_levels).select("col_name").limit(1).collect()
    if too_many:
        raise ValueError(f"column {too_many[0][0]} has more than {max_levels} levels")
    out: dict[str, list] = {c: [] for c in cols}
    for r in long.collect():
        out[r["col_name"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}
