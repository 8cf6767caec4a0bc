"""Further queries: selection by type, semi join, explicit splits and balancing, nominal summary
by class, mean confidence interval, t-test p-values, tree prediction."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import pvalues
from quarry.operators import explore, importance, sampling, select, tree
from quarry.plans.common import mo, with_mo
from quarry.plans.fixtures import split_sql

D = 6


def select_by_type(spark, sf_dir):
    d = mo(spark, sf_dir)
    return d.select("id", *select.columns_of_kind(d, "numeric", exclude=["id", "target_b", "target_s", "target_d"]))


def semi_join(spark, sf_dir):
    """Orders that have at least one line with a return flag R (left semi join)."""
    from quarry.sources.tables import read_table
    li = read_table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("id"))
    return select.semi_member(mo(spark, sf_dir).select("id", "totalprice"), li, "id")


def split_two(spark, sf_dir):
    s = sampling.stratified_split(mo(spark, sf_dir), "target_s", "id", (0.5,), ("train", "valid"), 42)
    return s.groupBy("target_s", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


def split_three(spark, sf_dir):
    s = sampling.stratified_split(mo(spark, sf_dir), "target_s", "id", (0.5, 0.25), ("train", "valid", "test"), 42)
    return s.groupBy("target_s", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


def downsample(spark, sf_dir):
    d = sampling.downsample(mo(spark, sf_dir), "target_b", "id", seed=7)
    return d.groupBy("target_b").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


def downsample_plus_valid(spark, sf_dir):
    """The rows kept for modelling: a class-balanced down-sample of the training part plus every
    validation row (M4), as (id, split, target_b)."""
    d = sampling.stratified_split(mo(spark, sf_dir), "target_b", "id", (0.5,), ("train", "valid"), 42)
    sample = sampling.downsample(d.filter(F.col("split") == "train"), "target_b", "id", seed=7)
    flagged = select.member_flag(d, sample, "id", out="in_sample")
    return flagged.filter((F.col("in_sample") == 1) | (F.col("split") == "valid")).select("id", "split", "target_b")


def rank_measures(spark, sf_dir):
    """Ten highest and ten lowest order totals with their rank (ties by id), A16/A17."""
    d = mo(spark, sf_dir).select("id", "totalprice")
    top = explore.top_n(d, "totalprice", 10, "id").withColumn("direction", F.lit("top"))
    low = explore.top_n(d, "totalprice", 10, "id", descending=False).withColumn("direction", F.lit("bottom"))
    both = top.unionByName(low)
    # 20 rows: the rank is a window over that bounded set.
    from pyspark.sql import Window
    w = Window.partitionBy("direction").orderBy(
        F.when(F.col("direction") == "top", -F.col("totalprice")).otherwise(F.col("totalprice")), "id")
    return both.withColumn("rnk", F.row_number().over(w))


def argmax_all(spark, sf_dir):
    """Every row whose line count equals the maximum (ties kept), with its position.

    The maximum is one aggregate brought back as a literal; the filter is then a pushed-down
    predicate on the view scan.
    """
    d = mo(spark, sf_dir)
    top = d.agg(F.max("n_lines").alias("m")).first()["m"]
    idx = select.with_row_index(d.select("id", "n_lines"), "id")
    return idx.filter(F.col("n_lines") == F.lit(top))


def class_flag_counts(spark, sf_dir):
    """Class counts, the minority count and sums of missing flags."""
    from quarry.operators import transforms
    d = transforms.add_missing_flags(mo(spark, sf_dir), ["bal", "n_lines"])
    per = d.groupBy("target_b").agg(F.count(F.lit(1)).alias("n"), F.sum("bal_NA").alias("bal_na"),
                                    F.sum("n_lines_NA").alias("n_lines_na"))
    from pyspark.sql import Window
    return per.withColumn("minority_n", F.min("n").over(Window.partitionBy()))   # one row per class


def rank_all(spark, sf_dir):
    """Every order with its exact rank by total price, highest first (ties: higher id first); A17 full sort."""
    from quarry.operators.ranking import with_running_totals
    d = mo(spark, sf_dir).select("id", "totalprice")
    return with_running_totals(d, "totalprice", {"rnk": F.lit(1).cast("long")}, tie_cols=["id"], descending=True)


def inverse_prior_weights(spark, sf_dir):
    w = sampling.inverse_prior_weights(mo(spark, sf_dir), "target_b")
    return w.groupBy("target_b").agg(F.count(F.lit(1)).alias("n"), F.round(F.first("weight"), D).alias("weight"))


def summary_nominal_by_target(spark, sf_dir):
    return explore.level_counts(mo(spark, sf_dir), ["segment", "status"], group_cols=["target_s"])


@F.pandas_udf(T.DoubleType())
def _t975(dof: pd.Series) -> pd.Series:
    return pd.Series([pvalues.t_quantile(0.975, d) if d and d > 0 else float("nan") for d in dof])


def mean_ci(spark, sf_dir):
    """Mean with its 95% t confidence interval per numeric column (the CI part of basic stats)."""
    m = explore.moments(mo(spark, sf_dir), ["totalprice", "bal", "n_lines", "sum_qty", "avg_price"])
    t = _t975((F.col("n") - 1).cast("double"))
    return m.select("col_name", "n", "mean", (F.col("mean") - t * F.col("se")).alias("ci_low"),
                    (F.col("mean") + t * F.col("se")).alias("ci_high"))


def ttest_pvalues(spark, sf_dir):
    t = importance.welch_t(mo(spark, sf_dir), ["totalprice", "bal", "n_lines", "sum_qty", "avg_price"], "target_s")
    return t.select("col_name", "t", "df", importance.t_p("t", "df").alias("p_value"))


def anova_pvalues(spark, sf_dir):
    a = importance.anova_f(mo(spark, sf_dir), ["segment", "status", "order_month"], "totalprice")
    return a.select("col_name", "f", "df1", "df2", importance.f_p("f", "df1", "df2").alias("p_value"))


def tree_predict(spark, sf_dir):
    """Class and P(event) of validation rows from the pruned tree chosen on validation."""
    from quarry.plans.q_models import TARGET, _frame, _grown
    _, model, nodes, path, evals = _grown(spark, sf_dir)
    _, _, valid, _ = _frame(spark, sf_dir)
    best = path[tree.choose(evals)["index"]]
    scored = model.with_probability(valid.select("id", TARGET, *model.inputs.names), nodes, best)
    return scored.select("id", TARGET, "pred_prob",
                         (F.col("pred_prob") > 0.5).cast("int").alias("pred_class"))


QUERIES = {
    "select_by_type": select_by_type,
    "semi_join": semi_join,
    "split_two": split_two,
    "split_three": split_three,
    "downsample": downsample,
    "inverse_prior_weights": inverse_prior_weights,
    "downsample_plus_valid": downsample_plus_valid,
    "argmax_all": argmax_all,
    "rank_all": rank_all,
    "class_flag_counts": class_flag_counts,
    "rank_measures": rank_measures,
    "summary_nominal_by_target": summary_nominal_by_target,
    "mean_ci": mean_ci,
    "ttest_pvalues": ttest_pvalues,
    "anova_pvalues": anova_pvalues,
    "tree_predict": tree_predict,
}

_SPLIT3 = """,
split AS (
  SELECT *, CASE WHEN rk <= floor(0.5 * n + 0.5) THEN 'train' WHEN rk <= floor(0.75 * n + 0.5) THEN 'valid'
                 ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY target_s ORDER BY md5(CAST(id AS VARCHAR) || '|42'), id) AS rk,
               count(*) OVER (PARTITION BY target_s) AS n FROM mining_orders))"""

ORACLE = {
    "rank_all": with_mo(" SELECT id, totalprice, row_number() OVER (ORDER BY totalprice DESC, id DESC) AS rnk "
                        "FROM mining_orders"),
    "argmax_all": with_mo(""", ri AS (SELECT id, n_lines, row_number() OVER (ORDER BY id) AS row_idx FROM mining_orders)
SELECT id, n_lines, row_idx FROM ri WHERE n_lines = (SELECT max(n_lines) FROM mining_orders)"""),
    "class_flag_counts": with_mo(""", per AS (SELECT target_b, count(*) AS n,
       CAST(sum(CASE WHEN bal IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS bal_na,
       CAST(sum(CASE WHEN n_lines IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_lines_na FROM mining_orders GROUP BY 1)
SELECT *, min(n) OVER () AS minority_n FROM per"""),
    "downsample_plus_valid": with_mo(split_sql("target_b", 0.5, 42) + """,
tr AS (SELECT id, target_b, row_number() OVER (PARTITION BY target_b ORDER BY md5(CAST(id AS VARCHAR) || '|7'), id) AS rk
       FROM split WHERE split = 'train'),
samp AS (SELECT id FROM tr WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM tr GROUP BY target_b)))
SELECT id, split, target_b FROM split WHERE split = 'valid' OR id IN (SELECT id FROM samp)"""),
    "rank_measures": with_mo(""", t AS (SELECT id, totalprice, 'top' AS direction FROM mining_orders ORDER BY totalprice DESC, id LIMIT 10),
b AS (SELECT id, totalprice, 'bottom' AS direction FROM mining_orders ORDER BY totalprice, id LIMIT 10),
u AS (SELECT * FROM t UNION ALL SELECT * FROM b)
SELECT id, totalprice, direction, CAST(row_number() OVER (PARTITION BY direction ORDER BY
       CASE WHEN direction = 'top' THEN -totalprice ELSE totalprice END, id) AS INTEGER) AS rnk FROM u"""),
    "select_by_type": with_mo(" SELECT id, totalprice, bal, n_lines, sum_qty, avg_price, order_month FROM mining_orders"),
    "semi_join": with_mo(" SELECT id, totalprice FROM mining_orders WHERE id IN "
                         "(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"),
    "split_two": with_mo(split_sql("target_s", 0.5, 42) + " SELECT target_s, split, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum "
                         "FROM split GROUP BY 1, 2"),
    "split_three": with_mo(_SPLIT3 + " SELECT target_s, split, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum FROM split GROUP BY 1, 2"),
    "downsample": with_mo(""", r AS (SELECT *, row_number() OVER (PARTITION BY target_b
                                     ORDER BY md5(CAST(id AS VARCHAR) || '|7'), id) AS rk FROM mining_orders)
SELECT target_b, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum FROM r
WHERE rk <= (SELECT min(c) FROM (SELECT count(*) AS c FROM mining_orders GROUP BY target_b)) GROUP BY 1"""),
    "inverse_prior_weights": with_mo(" SELECT target_b, count(*) AS n, round(sum(count(*)) OVER () / count(*), 6) AS weight "
                                     "FROM mining_orders GROUP BY 1"),
    "summary_nominal_by_target": with_mo(" " + " UNION ALL ".join(
        f"SELECT target_s, '{c}' AS col_name, CAST({c} AS VARCHAR) AS level, count(*) AS n FROM mining_orders GROUP BY 1, 3"
        for c in ["segment", "status"])),
}
