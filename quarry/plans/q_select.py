"""Queries for projections, row selection, membership and the input-role profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.operators import impute, sampling, select
from quarry.plans.common import mo, with_mo
from quarry.plans.fixtures import split_sql
from quarry.sources.tables import read_table

NON_INPUTS = "^(id|target)"


def select_regex(spark, sf_dir):
    # inputs = all but id/target*, with target_s restored
    return select.select_by_regex(mo(spark, sf_dir), NON_INPUTS, reject=True, keep=["target_s"])


def select_position(spark, sf_dir):
    return select.select_by_position(mo(spark, sf_dir), [1, 2, 3])


def drop_position(spark, sf_dir):
    return select.drop_by_position(mo(spark, sf_dir), [2, 3, 4, 6])


def row_slice(spark, sf_dir):
    return select.row_slice(mo(spark, sf_dir), "id", 1, 20).select("row_idx", "id", "totalprice")


def row_exclude(spark, sf_dir):
    return select.row_slice(mo(spark, sf_dir), "id", 10, 85, exclude=True).select("row_idx", "id")


def cell_lookup(spark, sf_dir):
    return select.row_slice(mo(spark, sf_dir), "id", 1, 1).select("target_b")


def which_rows(spark, sf_dir):
    cond = (F.col("totalprice") > 450000) & (F.col("status") == "F")
    return select.which_rows(mo(spark, sf_dir), cond, "id")


def filter_and_or(spark, sf_dir):
    d = mo(spark, sf_dir)
    cond = ((F.col("status") == "F") & (F.col("totalprice") > 300000)) | (F.col("segment") == "BUILDING")
    return d.filter(cond).select("id", "status", "totalprice", "segment")


def complete_cases(spark, sf_dir):
    return select.complete_cases(mo(spark, sf_dir), ["target_d"]).select("id", "target_d")


def sentinel_null(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_returnflag", fc.sentinel_null("l_discount", 0.0).alias("discount"))
    return li.groupBy("l_returnflag").agg(
        F.count("discount").alias("n_value"), F.count_if(F.col("discount").isNull()).alias("n_null"),
        F.round(F.avg("discount"), 6).alias("avg_discount"))


def range_null(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").select("p_type", fc.below_null("p_size", 10).alias("size"))
    return p.groupBy("p_type").agg(
        F.count("size").alias("n_value"), F.count_if(F.col("size").isNull()).alias("n_null"),
        F.round(F.avg("size"), 6).alias("avg_size"))


def semi_member(spark, sf_dir):
    """Down-sampled training rows plus every validation row."""
    d = sampling.stratified_split(mo(spark, sf_dir), "target_b", "id", (0.5,), ("train", "valid"), 42)
    sample = sampling.downsample(d.filter(F.col("split") == "train"), "target_b", "id", seed=7)
    flagged = select.member_flag(d, sample, "id", out="in_sample")
    kept = flagged.filter((F.col("in_sample") == 1) | (F.col("split") == "valid"))
    return kept.groupBy("split", "target_b").agg(F.count(F.lit(1)).alias("n"),
                                                 F.sum("in_sample").alias("n_in_sample"))


def append_predictions(spark, sf_dir):
    """Raw columns + pred_prob + pred_class; features are derived under a private prefix."""
    d = mo(spark, sf_dir)
    means = impute.fit_means(d, ["bal"])
    f = d.withColumn("__f_bal", F.coalesce(F.col("bal"), F.lit(means["bal"])))
    z = fc.linear_predictor({"totalprice": 1e-5, "__f_bal": 2e-4}, -4.0)
    prob = F.round(fc.sigmoid(z), 6)
    out = f.withColumn("pred_prob", prob).withColumn("pred_class", fc.cutoff_class("pred_prob", 0.5, strict=True))
    return out.drop("__f_bal")


def role_profile(spark, sf_dir):
    return select.role_profile(mo(spark, sf_dir), NON_INPUTS).withColumnRenamed("column", "col_name")


QUERIES = {
    "select_regex": select_regex,
    "select_position": select_position,
    "drop_position": drop_position,
    "row_slice": row_slice,
    "row_exclude": row_exclude,
    "cell_lookup": cell_lookup,
    "which_rows": which_rows,
    "filter_and_or": filter_and_or,
    "complete_cases": complete_cases,
    "sentinel_null": sentinel_null,
    "range_null": range_null,
    "semi_member": semi_member,
    "append_predictions": append_predictions,
    "role_profile": role_profile,
}

_ROWIDX = ", ri AS (SELECT *, row_number() OVER (ORDER BY id) AS row_idx FROM mining_orders)"
# (position, name, numeric, nominal) of mining_orders; non-inputs are id and target_*.
_MO_COLS = [("id", 1, 0), ("target_b", 1, 0), ("target_s", 1, 0), ("target_d", 1, 0), ("price_text", 0, 1),
            ("totalprice", 1, 0), ("bal", 1, 0), ("segment", 0, 1), ("status", 0, 1), ("n_lines", 1, 0),
            ("sum_qty", 1, 0), ("avg_price", 1, 0), ("order_month", 1, 0)]


def _role_sql():
    parts = []
    for pos, (c, num, nom) in enumerate(_MO_COLS, start=1):
        inp = not (c == "id" or c.startswith("target"))
        parts.append(
            f"SELECT {pos} AS position, '{c}' AS col_name, {str(bool(inp and num)).lower()} AS numeric, "
            f"{str(bool(inp and nom)).lower()} AS nominal, "
            f"{'bool_or(' + c + ' IS NULL)' if inp else 'bool_and(false)'} AS missing FROM mining_orders")
    return with_mo(" " + " UNION ALL ".join(parts))


ORACLE = {
    "select_regex": with_mo(" SELECT target_s, price_text, totalprice, bal, segment, status, n_lines, sum_qty, "
                            "avg_price, order_month FROM mining_orders"),
    "select_position": with_mo(" SELECT id, target_b, target_s FROM mining_orders"),
    "drop_position": with_mo(" SELECT id, price_text, bal, segment, status, n_lines, sum_qty, avg_price, "
                             "order_month FROM mining_orders"),
    "row_slice": with_mo(_ROWIDX + " SELECT row_idx, id, totalprice FROM ri WHERE row_idx BETWEEN 1 AND 20"),
    "row_exclude": with_mo(_ROWIDX + " SELECT row_idx, id FROM ri WHERE NOT (row_idx BETWEEN 10 AND 85)"),
    "cell_lookup": with_mo(_ROWIDX + " SELECT target_b FROM ri WHERE row_idx = 1"),
    "which_rows": with_mo(_ROWIDX + " SELECT row_idx FROM ri WHERE totalprice > 450000 AND status = 'F'"),
    "filter_and_or": with_mo(" SELECT id, status, totalprice, segment FROM mining_orders "
                             "WHERE (status = 'F' AND totalprice > 300000) OR segment = 'BUILDING'"),
    "complete_cases": with_mo(" SELECT id, target_d FROM mining_orders WHERE target_d IS NOT NULL"),
    "sentinel_null": "SELECT l_returnflag, count(d) AS n_value, count(*) FILTER (WHERE d IS NULL) AS n_null, "
                     "round(avg(d), 6) AS avg_discount FROM (SELECT l_returnflag, nullif(l_discount, 0.0) AS d "
                     "FROM lineitem) GROUP BY l_returnflag",
    "range_null": "SELECT p_type, count(s) AS n_value, count(*) FILTER (WHERE s IS NULL) AS n_null, "
                  "round(avg(s), 6) AS avg_size FROM (SELECT p_type, CASE WHEN p_size >= 10 THEN p_size END AS s "
                  "FROM part) GROUP BY p_type",
    "semi_member": with_mo(split_sql("target_b", 0.5, 42) + """,
tr AS (SELECT id, target_b, row_number() OVER (PARTITION BY target_b ORDER BY md5(CAST(id AS VARCHAR) || '|7'), id) AS rk
       FROM split WHERE split = 'train'),
samp AS (SELECT id FROM tr WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM tr GROUP BY target_b))),
flagged AS (SELECT s.*, CASE WHEN p.id IS NULL THEN 0 ELSE 1 END AS in_sample FROM split s LEFT JOIN samp p ON s.id = p.id)
SELECT split, target_b, count(*) AS n, CAST(sum(in_sample) AS BIGINT) AS n_in_sample FROM flagged
WHERE in_sample = 1 OR split = 'valid' GROUP BY split, target_b"""),
    "append_predictions": with_mo(""",
f AS (SELECT *, coalesce(bal, (SELECT avg(bal) FROM mining_orders)) AS __f_bal FROM mining_orders),
p AS (SELECT * EXCLUDE (__f_bal), round(1.0 / (1.0 + exp(-(-4.0 + 1e-05 * totalprice + 0.0002 * __f_bal))), 6) AS pred_prob
      FROM f)
SELECT *, CASE WHEN pred_prob > 0.5 THEN 1 ELSE 0 END AS pred_class FROM p"""),
    "role_profile": _role_sql(),
}
