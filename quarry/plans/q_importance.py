"""Queries for variable importance (V1-V6) on `mining_orders`."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import importance
from quarry.plans.common import mo, with_mo

D = 6
NOMINAL = ["segment", "status", "order_month"]
NUMERIC = ["totalprice", "bal", "n_lines", "sum_qty", "avg_price"]
NUM_FOR_D = ["bal", "n_lines", "sum_qty", "avg_price"]


def chi2_rank(spark, sf_dir):
    c = importance.chi2_table(mo(spark, sf_dir), NOMINAL, "target_s")
    return c.select("col_name", F.round("statistic", D).alias("statistic"), "df")


def chi2_pvalues(spark, sf_dir):
    c = importance.chi2_table(mo(spark, sf_dir), NOMINAL, "target_s")
    return c.select("col_name", "statistic", "df", importance.chi2_p("statistic", "df").alias("p_value"))


def ttest_rank(spark, sf_dir):
    t = importance.welch_t(mo(spark, sf_dir), NUMERIC, "target_s")
    return t.select("col_name", F.round("t", D).alias("t"), F.round("df", 4).alias("df"))


def auc_rank(spark, sf_dir):
    d = importance.level_codes(mo(spark, sf_dir), ["segment", "status"])
    a = importance.single_input_auc(d, NUMERIC + ["segment", "status"], "target_s")
    return a.select("col_name", F.round("auc", D).alias("auc"))


def corr_rank(spark, sf_dir):
    c = importance.abs_correlation(mo(spark, sf_dir), NUM_FOR_D, "target_d")
    return c.select("col_name", F.round("corr", D).alias("corr"), F.round("abs_corr", D).alias("abs_corr"))


def anova_rank(spark, sf_dir):
    a = importance.anova_f(mo(spark, sf_dir), NOMINAL, "totalprice")
    return a.select("col_name", F.round("f", D).alias("f"), "df1", "df2")


def binned_r2_rank(spark, sf_dir):
    r = importance.binned_r2(mo(spark, sf_dir), NUM_FOR_D, "totalprice")
    return r.select("col_name", F.round("r2", D).alias("r2"))


QUERIES = {
    "chi2_rank": chi2_rank,
    "chi2_pvalues": chi2_pvalues,
    "ttest_rank": ttest_rank,
    "auc_rank": auc_rank,
    "corr_rank": corr_rank,
    "anova_rank": anova_rank,
    "binned_r2_rank": binned_r2_rank,
}


def _long(cols, y, vtype="DOUBLE"):
    return " UNION ALL ".join(f"SELECT '{c}' AS col_name, CAST({c} AS {vtype}) AS value, {y} AS y FROM mining_orders"
                              for c in cols)


_CODES = """, codes AS (SELECT *, CAST(dense_rank() OVER (ORDER BY segment) AS DOUBLE) AS segment_code FROM mining_orders
              WHERE segment IS NOT NULL),
codes2 AS (SELECT *, CAST(dense_rank() OVER (ORDER BY status) AS DOUBLE) AS status_code FROM mining_orders)"""

ORACLE = {
    "chi2_rank": with_mo(f""", l AS ({_long(NOMINAL, 'target_s', 'VARCHAR')}),
f AS (SELECT * FROM l WHERE value IS NOT NULL AND y IS NOT NULL),
lv AS (SELECT DISTINCT col_name, value FROM f), cl AS (SELECT DISTINCT y FROM f),
o AS (SELECT col_name, value, y, count(*) AS o FROM f GROUP BY ALL),
g AS (SELECT lv.col_name, lv.value, cl.y, coalesce(o.o, 0) AS o FROM lv CROSS JOIN cl
      LEFT JOIN o ON o.col_name = lv.col_name AND o.value = lv.value AND o.y = cl.y),
m AS (SELECT *, sum(o) OVER (PARTITION BY col_name, value) AS rn, sum(o) OVER (PARTITION BY col_name, y) AS cn,
             sum(o) OVER (PARTITION BY col_name) AS n, count(*) OVER (PARTITION BY col_name) / (SELECT count(*) FROM cl) AS r,
             (SELECT count(*) FROM cl) AS k FROM g),
x AS (SELECT *, rn * cn / n AS e FROM m)
SELECT col_name, round(sum(pow(abs(o - e) - CASE WHEN r = 2 AND k = 2 THEN least(0.5, abs(o - e)) ELSE 0 END, 2) / e), 6)
         AS statistic, CAST((any_value(r) - 1) * (any_value(k) - 1) AS BIGINT) AS df
FROM x GROUP BY col_name"""),
    "ttest_rank": with_mo(f""", l AS ({_long(NUMERIC, 'target_s')}),
g AS (SELECT col_name, count(value) FILTER (WHERE y = 0) AS n0, count(value) FILTER (WHERE y = 1) AS n1,
             avg(value) FILTER (WHERE y = 0) AS m0, avg(value) FILTER (WHERE y = 1) AS m1,
             var_samp(value) FILTER (WHERE y = 0) / count(value) FILTER (WHERE y = 0) AS a0,
             var_samp(value) FILTER (WHERE y = 1) / count(value) FILTER (WHERE y = 1) AS a1
      FROM l WHERE value IS NOT NULL GROUP BY col_name)
SELECT col_name, round((m0 - m1) / sqrt(a0 + a1), 6) AS t,
       round(pow(a0 + a1, 2) / (pow(a0, 2) / (n0 - 1) + pow(a1, 2) / (n1 - 1)), 4) AS df FROM g"""),
    "auc_rank": with_mo(_CODES + f""",
l AS ({_long(NUMERIC, 'target_s')} UNION ALL SELECT 'segment', segment_code, target_s FROM codes
      UNION ALL SELECT 'status', status_code, target_s FROM codes2),
c AS (SELECT col_name, value, sum(y) AS pos, sum(1 - y) AS neg FROM l WHERE value IS NOT NULL GROUP BY col_name, value),
cum AS (SELECT *, sum(neg) OVER (PARTITION BY col_name ORDER BY value) AS neg_le FROM c),
a AS (SELECT col_name, sum(pos * (neg_le - neg + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM cum GROUP BY col_name)
SELECT col_name, round(greatest(auc, 1 - auc), 6) AS auc FROM a"""),
    "corr_rank": with_mo(f""", l AS ({_long(NUM_FOR_D, 'target_d')})
SELECT col_name, round(corr(value, y), 6) AS corr, round(abs(corr(value, y)), 6) AS abs_corr
FROM l WHERE value IS NOT NULL AND y IS NOT NULL GROUP BY col_name"""),
    "anova_rank": with_mo(f""", l AS ({_long(NOMINAL, 'totalprice', 'VARCHAR')}),
f AS (SELECT * FROM l WHERE value IS NOT NULL AND y IS NOT NULL),
g AS (SELECT col_name, value, count(*) AS ng, avg(y) AS mg, var_samp(y) AS vg FROM f GROUP BY col_name, value),
t AS (SELECT col_name, count(*) AS n, avg(y) AS m FROM f GROUP BY col_name),
s AS (SELECT g.col_name, sum(ng * pow(mg - m, 2)) AS ssb, sum(coalesce((ng - 1) * vg, 0)) AS ssw, count(*) AS k,
             any_value(n) AS n FROM g JOIN t ON g.col_name = t.col_name GROUP BY g.col_name)
SELECT col_name, round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS f, CAST(k - 1 AS BIGINT) AS df1,
       CAST(n - k AS BIGINT) AS df2 FROM s"""),
    "binned_r2_rank": with_mo(f""", l AS ({_long(NUM_FOR_D, 'totalprice')}),
f AS (SELECT * FROM l WHERE value IS NOT NULL AND y IS NOT NULL),
q AS (SELECT col_name, {', '.join(f'quantile_cont(value, {i / 10}) AS q{i}' for i in range(1, 10))}
      FROM f GROUP BY col_name),
b AS (SELECT f.col_name, f.y, {' + '.join(f'CAST(f.value > q.q{i} AS INTEGER)' for i in range(1, 10))} AS bin
      FROM f JOIN q ON f.col_name = q.col_name),
w AS (SELECT col_name, sum(coalesce((nb - 1) * vb, 0)) AS ssw FROM
        (SELECT col_name, bin, count(*) AS nb, var_samp(y) AS vb FROM b GROUP BY col_name, bin) GROUP BY col_name),
t AS (SELECT col_name, (count(*) - 1) * var_samp(y) AS sst FROM f GROUP BY col_name)
SELECT w.col_name, round(1 - ssw / sst, 6) AS r2 FROM w JOIN t ON w.col_name = t.col_name"""),
}
