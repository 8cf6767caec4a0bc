"""Queries for exploration aggregates (P7 profile aside): A1-A17."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.operators.joins import join_null_safe
from quarry.operators import explore
from quarry.plans.common import mo, so, with_mo, with_so

D = 6
NUM = ["totalprice", "bal", "n_lines", "sum_qty", "avg_price"]
NOM = ["segment", "status"]


def _r(cols):
    return [F.round(c, D).alias(c) for c in cols]


def summary_numeric(spark, sf_dir):
    return explore.numeric_summary(mo(spark, sf_dir), NUM)


def summary_nominal(spark, sf_dir):
    return explore.level_counts(mo(spark, sf_dir), NOM)


def basic_stats(spark, sf_dir):
    d = mo(spark, sf_dir)
    m = explore.moments(d, NUM)
    q = explore.quantile_table(d, NUM, [0.25, 0.5, 0.75]).groupBy("col_name").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    j = m.join(q, "col_name", "left")
    # Large sums of squares differ in the last bits between engines: coarser rounding for them.
    return j.select("col_name", "n", "n_na", *_r(["min", "max", "q1", "median", "q3", "mean", "se", "skew", "kurt"]),
                    F.round("sum", 2).alias("sum"), F.round("var", 0).alias("var"), F.round("sd", 4).alias("sd"))


def skew_kurt(spark, sf_dir):
    m = explore.moments(mo(spark, sf_dir), NUM)
    return m.select("col_name", *_r(["skew", "kurt"]))


def missing_fraction(spark, sf_dir):
    return explore.missing_fraction(mo(spark, sf_dir)).select("col_name", F.round("frac_missing", D).alias("frac_missing"))


def missing_columns(spark, sf_dir):
    from quarry.operators.select import row_slice
    d = mo(spark, sf_dir)
    whole = explore.missing_fraction(d).filter(F.col("frac_missing") > 0).select(
        "col_name", F.lit("all").alias("scope"))
    first = row_slice(d, "id", 1, 100).drop("row_idx")
    part = explore.missing_fraction(first).filter(F.col("frac_missing") > 0).select(
        "col_name", F.lit("rows_1_100").alias("scope"))
    return whole.unionByName(part)


def missing_map(spark, sf_dir):
    return explore.missing_map(mo(spark, sf_dir), "id", 1000)


def freq_desc(spark, sf_dir):
    return explore.freq_desc(mo(spark, sf_dir), "segment")


def histogram(spark, sf_dir):
    h = explore.histogram(mo(spark, sf_dir), ["totalprice", "avg_price"], 10)
    return h.select("col_name", "bin", *_r(["lo", "hi"]), "n")


def contingency(spark, sf_dir):
    return explore.contingency(mo(spark, sf_dir), "segment", "status")


def crosstable(spark, sf_dir):
    s = so(spark, sf_dir).select("actual", fc.cutoff_class("prob", 0.5).alias("pred_class"))
    ct = explore.crosstable(s, "pred_class", "actual")
    return ct.select("pred_class", "actual", "n", *_r(["row_share", "col_share", "total_share", "chi2_contrib"]))


def summary_by_target(spark, sf_dir):
    return explore.numeric_summary(mo(spark, sf_dir), NUM, group_cols=["target_s"])


def describe_by_target(spark, sf_dir):
    d = mo(spark, sf_dir)
    cols = ["totalprice", "bal", "sum_qty"]
    m = explore.moments(d, cols, ["target_s"])
    tm = explore.trimmed_mean_mad(d, cols, ["target_s"])            # also yields the median
    j = join_null_safe(m, tm, ["target_s", "col_name"], "left")
    j = j.withColumn("range", F.col("max") - F.col("min"))
    return j.select("target_s", "col_name", "n", *_r(["mean", "sd", "median", "trimmed_mean", "mad", "min", "max",
                                                      "range", "skew", "kurt", "se"]))


def class_shares(spark, sf_dir):
    c = explore.class_shares(mo(spark, sf_dir), "target_b")
    return c.select("level", "n", *_r(["share", "inverse_prior"]))


def rank_top10(spark, sf_dir):
    return explore.top_n(mo(spark, sf_dir).select("id", "totalprice"), "totalprice", 10, "id")


def arg_extremes(spark, sf_dir):
    return explore.arg_extremes(mo(spark, sf_dir), "totalprice", "id")


QUERIES = {
    "summary_numeric": summary_numeric,
    "summary_nominal": summary_nominal,
    "basic_stats": basic_stats,
    "skew_kurt": skew_kurt,
    "missing_fraction": missing_fraction,
    "missing_columns": missing_columns,
    "missing_map": missing_map,
    "freq_desc": freq_desc,
    "histogram": histogram,
    "contingency": contingency,
    "crosstable": crosstable,
    "summary_by_target": summary_by_target,
    "describe_by_target": describe_by_target,
    "class_shares": class_shares,
    "rank_top10": rank_top10,
    "arg_extremes": arg_extremes,
}

_MO_ALL = ["id", "target_b", "target_s", "target_d", "price_text", "totalprice", "bal", "segment", "status",
           "n_lines", "sum_qty", "avg_price", "order_month"]


def _long(cols, group="", src="mining_orders"):
    g = f"{group}, " if group else ""
    return " UNION ALL ".join(f"SELECT {g}'{c}' AS col_name, CAST({c} AS DOUBLE) AS v FROM {src}" for c in cols)


def _summary_sql(group=""):
    g = f"{group}, " if group else ""
    return with_mo(f""", l AS ({_long(NUM, group)})
SELECT {g}col_name, round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS q1,
       round(quantile_cont(v, 0.5), 6) AS median, round(avg(v), 6) AS mean,
       round(quantile_cont(v, 0.75), 6) AS q3, round(max(v), 6) AS max,
       count(*) FILTER (WHERE v IS NULL) AS n_na
FROM l GROUP BY {g}col_name""")


_MOMENTS = """count(v) AS n, count(*) FILTER (WHERE v IS NULL) AS n_na, min(v) AS min, max(v) AS max, sum(v) AS sum,
       avg(v) AS mean, var_samp(v) AS var, stddev_samp(v) AS sd, stddev_samp(v) / sqrt(count(v)) AS se"""


def _skew_sql(group=""):
    g = f"{group}, " if group else ""
    on = " AND ".join(["l.col_name = m.col_name"] + ([f"l.{group} = m.{group}"] if group else []))
    return f"""m AS (SELECT {g}col_name, avg(v) AS mu, stddev_samp(v) AS s FROM l GROUP BY {g}col_name),
sk AS (SELECT {('l.' + group + ', ') if group else ''}l.col_name, avg(pow(v - mu, 3)) / pow(any_value(s), 3) AS skew,
              avg(pow(v - mu, 4)) / pow(any_value(s), 4) - 3 AS kurt
       FROM l JOIN m ON {on} GROUP BY {('l.' + group + ', ') if group else ''}l.col_name)"""


ORACLE = {
    "summary_numeric": _summary_sql(),
    "summary_nominal": with_mo(" " + " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, CAST({c} AS VARCHAR) AS level, count(*) AS n FROM mining_orders GROUP BY 2"
        for c in NOM)),
    "basic_stats": with_mo(f""", l AS ({_long(NUM)}),
st AS (SELECT col_name, {_MOMENTS}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
              quantile_cont(v, 0.75) AS q3 FROM l GROUP BY col_name),
{_skew_sql()}
SELECT st.col_name, n, n_na, round(min, 6) AS min, round(max, 6) AS max, round(q1, 6) AS q1,
       round(median, 6) AS median, round(q3, 6) AS q3, round(sum, 2) AS sum, round(mean, 6) AS mean,
       round(var, 0) AS var, round(sd, 4) AS sd, round(se, 6) AS se, round(skew, 6) AS skew, round(kurt, 6) AS kurt
FROM st JOIN sk ON st.col_name = sk.col_name"""),
    "skew_kurt": with_mo(f""", l AS ({_long(NUM)}),
{_skew_sql()}
SELECT col_name, round(skew, 6) AS skew, round(kurt, 6) AS kurt FROM sk"""),
    "missing_fraction": with_mo(" " + " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS frac_missing "
        f"FROM mining_orders" for c in _MO_ALL)),
    "missing_columns": with_mo(", ri AS (SELECT * FROM mining_orders ORDER BY id LIMIT 100) " + " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, 'all' AS scope FROM mining_orders HAVING bool_or({c} IS NULL) UNION ALL "
        f"SELECT '{c}', 'rows_1_100' FROM ri HAVING bool_or({c} IS NULL)" for c in _MO_ALL)),
    "missing_map": with_mo(", ri AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 1000) AS BIGINT) AS "
                           "row_block FROM mining_orders) " + " UNION ALL ".join(
        f"SELECT row_block, '{c}' AS col_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing, "
        f"count(*) AS n_rows FROM ri GROUP BY row_block" for c in _MO_ALL if c != "id")),
    "freq_desc": with_mo(" SELECT segment AS level, count(*) AS n FROM mining_orders GROUP BY 1"),
    "histogram": with_mo(f""", l AS ({_long(["totalprice", "avg_price"])}),
r AS (SELECT col_name, min(v) AS lo, max(v) AS hi FROM l WHERE v IS NOT NULL GROUP BY col_name),
b AS (SELECT l.col_name, r.lo, r.hi,
             CAST(CASE WHEN r.hi = r.lo THEN 1 ELSE least(greatest(ceil((v - r.lo) / ((r.hi - r.lo) / 10)), 1), 10) END
                  AS INTEGER) AS bin
      FROM l JOIN r ON l.col_name = r.col_name WHERE v IS NOT NULL)
SELECT col_name, bin, round(any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 10, 6) AS lo,
       round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 10, 6) AS hi, count(*) AS n
FROM b GROUP BY col_name, bin"""),
    "contingency": with_mo(""", c AS (SELECT segment, status, count(*) AS n FROM mining_orders GROUP BY 1, 2),
a AS (SELECT DISTINCT segment FROM mining_orders), b AS (SELECT DISTINCT status FROM mining_orders)
SELECT a.segment, b.status, coalesce(c.n, 0) AS n FROM a CROSS JOIN b
LEFT JOIN c ON c.segment IS NOT DISTINCT FROM a.segment AND c.status = b.status"""),
    "crosstable": with_so(""", s AS (SELECT actual, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS pred_class FROM scored_orders),
a AS (SELECT DISTINCT pred_class FROM s), b AS (SELECT DISTINCT actual FROM s),
c AS (SELECT a.pred_class, b.actual, (SELECT count(*) FROM s WHERE s.pred_class = a.pred_class AND s.actual = b.actual) AS n
      FROM a CROSS JOIN b),
m AS (SELECT *, sum(n) OVER (PARTITION BY pred_class) AS row_n, sum(n) OVER (PARTITION BY actual) AS col_n,
             sum(n) OVER () AS total FROM c)
SELECT pred_class, actual, n, round(n / row_n, 6) AS row_share, round(n / col_n, 6) AS col_share,
       round(n / total, 6) AS total_share,
       round(pow(n - row_n * col_n / total, 2) / (row_n * col_n / total), 6) AS chi2_contrib FROM m"""),
    "summary_by_target": _summary_sql("target_s"),
    "describe_by_target": with_mo(f""", l AS ({_long(["totalprice", "bal", "sum_qty"], "target_s")}),
st AS (SELECT target_s, col_name, {_MOMENTS}, quantile_cont(v, 0.5) AS median FROM l GROUP BY target_s, col_name),
{_skew_sql("target_s")},
rk AS (SELECT target_s, col_name, v, row_number() OVER (PARTITION BY target_s, col_name ORDER BY v) AS rn,
              count(*) OVER (PARTITION BY target_s, col_name) AS cn FROM l WHERE v IS NOT NULL),
tm AS (SELECT target_s, col_name, avg(v) AS trimmed_mean FROM rk
       WHERE rn BETWEEN floor(cn * 0.1) + 1 AND cn - floor(cn * 0.1) GROUP BY target_s, col_name),
md AS (SELECT l.target_s, l.col_name, quantile_cont(abs(v - st.median), 0.5) * 1.4826 AS mad
       FROM l JOIN st ON l.target_s = st.target_s AND l.col_name = st.col_name WHERE v IS NOT NULL
       GROUP BY l.target_s, l.col_name)
SELECT st.target_s, st.col_name, n, round(mean, 6) AS mean, round(sd, 6) AS sd, round(median, 6) AS median,
       round(trimmed_mean, 6) AS trimmed_mean, round(mad, 6) AS mad, round(min, 6) AS min, round(max, 6) AS max,
       round(max - min, 6) AS range, round(skew, 6) AS skew, round(kurt, 6) AS kurt, round(se, 6) AS se
FROM st JOIN sk ON st.target_s = sk.target_s AND st.col_name = sk.col_name
JOIN tm ON st.target_s = tm.target_s AND st.col_name = tm.col_name
JOIN md ON st.target_s = md.target_s AND st.col_name = md.col_name"""),
    "class_shares": with_mo(""", c AS (SELECT target_b AS level, count(*) AS n FROM mining_orders GROUP BY 1)
SELECT level, n, round(n / sum(n) OVER (), 6) AS share, round(sum(n) OVER () / n, 6) AS inverse_prior FROM c"""),
    "rank_top10": with_mo(" SELECT id, totalprice FROM mining_orders ORDER BY totalprice DESC, id LIMIT 10"),
    "arg_extremes": with_mo(" SELECT max(totalprice) AS max_value, arg_max(id, (totalprice, -id)) AS argmax_key, "
                            "min(totalprice) AS min_value, arg_min(id, (totalprice, id)) AS argmin_key FROM mining_orders"),
}
