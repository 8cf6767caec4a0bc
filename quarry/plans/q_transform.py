"""Queries for column transforms and imputation."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.operators import explore, impute, sampling, select, transforms
from quarry.plans.common import mo, so, with_mo, with_so
from quarry.plans.fixtures import split_sql
from quarry.sources.tables import read_table

D = 6
IMPUTE_COLS = ["bal", "n_lines", "sum_qty", "avg_price"]
STATUS_LEVELS = ["F", "P", "O"]                      # ordinal order F < P < O
SEGMENT_COLLAPSE = {"AUTOMOBILE": "AUTO", "BUILDING": "HOME", "HOUSEHOLD": "HOME", "MACHINERY": "INDUSTRY"}
PRIORITY_RECODE = {"1-URGENT": "HIGH", "2-HIGH": "HIGH", "3-MEDIUM": "MEDIUM"}


def _split(spark, sf_dir):
    split = sampling.stratified_split(mo(spark, sf_dir), "target_s", "id", (0.5,), ("train", "valid"), 42)
    return split.persist(StorageLevel.MEMORY_AND_DISK)   # read by the fit pass and the apply pass


def _train():
    return F.col("split") == "train"


def currency_parse(spark, sf_dir):
    return mo(spark, sf_dir).select("id", fc.parse_number("price_text").alias("amount"))


def cast_nominal(spark, sf_dir):
    """Month code as a nominal: levels in alphabetical (string) order with counts."""
    lv = mo(spark, sf_dir).groupBy(F.col("order_month").cast("string").alias("level")).agg(
        F.count(F.lit(1)).alias("n"))
    # The level table has one row per level.
    return lv.select("level", "n", F.row_number().over(Window.orderBy("level")).alias("level_order"))


def ordinal_rank(spark, sf_dir):
    d = mo(spark, sf_dir).select("status", fc.ordinal_rank("status", STATUS_LEVELS).alias("status_rank"))
    return d.groupBy("status", "status_rank").agg(F.count(F.lit(1)).alias("n"))


def level_collapse(spark, sf_dir):
    d = transforms.recode(mo(spark, sf_dir), "segment", SEGMENT_COLLAPSE, out="segment_group")
    return d.groupBy("segment_group").agg(F.count(F.lit(1)).alias("n"))


def recode_default_null(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(fc.level_map("o_orderpriority", PRIORITY_RECODE).alias("priority"))
    return o.groupBy("priority").agg(F.count(F.lit(1)).alias("n"))


def hour_daypart(spark, sf_dir):
    """Time text HH:mm:ss -> hour -> daypart bucket."""
    ev = read_table(spark, sf_dir, "events").select(F.date_format("ts", "HH:mm:ss").alias("time_text"))
    h = ev.select(fc.hour_of_text("time_text").alias("hour"))
    return h.groupBy(fc.daypart("hour").alias("daypart"), "hour").agg(F.count(F.lit(1)).alias("n"))


def weighted_score(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    s = fc.weighted_score(["l_discount", "l_tax"], [2 / 3, 1 / 3])
    return li.groupBy("l_returnflag").agg(F.round(F.avg(s), D).alias("avg_score"),
                                          F.round(F.max(s), D).alias("max_score"))


def log1p_cols(spark, sf_dir):
    d = mo(spark, sf_dir)
    cols = select.columns_matching(d, "^(totalprice|sum_qty|avg_price)")
    out = transforms.log1p_columns(d.select("id", *cols), cols)
    return out.select("id", *[F.round(c, D).alias(c) for c in cols])


def cutoff_class(spark, sf_dir):
    s = so(spark, sf_dir)
    return s.agg(*[F.sum(fc.cutoff_class("prob", cut, strict)).alias(f"n_{name}")
                   for cut, strict, name in [(0.5, True, "gt_050"), (0.5, False, "ge_050"),
                                             (0.3, True, "gt_030"), (0.3, False, "ge_030")]])


def poly_terms(spark, sf_dir):
    d = mo(spark, sf_dir).select("id", "totalprice", "bal", "sum_qty")
    pairs = transforms.all_pairs(["totalprice", "bal", "sum_qty"]) + [("bal", "bal")]
    out = transforms.products(d, pairs)
    names = [f"{a}_x_{b}" for a, b in pairs]
    return out.select("id", *[F.round(n, 4).alias(n) for n in names])


def math_scalars(spark, sf_dir):
    s = so(spark, sf_dir)
    # Probabilities of exactly 0 or 1 have no log odds: NULL, and the row stays.
    inside = (F.col("prob") > 0) & (F.col("prob") < 1)
    logit = F.when(inside, F.log(F.col("prob") / (F.lit(1.0) - F.col("prob"))))
    return s.select("id", F.round(F.abs(F.col("prob") - 0.2), D).alias("gap_02"),
                    F.round(logit, D).alias("log_odds"), F.round(F.exp(logit), D).alias("odds"))


def boxcox_lambda(spark, sf_dir):
    prof = transforms.power_profile(mo(spark, sf_dir), ["totalprice", "avg_price"], "boxcox")
    return transforms.best_lambda(prof).select("col_name", "lambda", "n")


def yeojohnson_lambda(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    prof = transforms.power_profile(c, ["c_acctbal"], "yeojohnson")
    return transforms.best_lambda(prof).select("col_name", "lambda", "n")


def yeojohnson_refined(spark, sf_dir):
    """Yeo-Johnson lambda: the 0.1 grid, then a 0.01 grid around its best value."""
    c = read_table(spark, sf_dir, "customer")
    r = transforms.refined_lambda(c, ["c_acctbal"], "yeojohnson")
    return r.select("col_name", F.round("lambda", 2).alias("lambda"), "n")


def standardize_train(spark, sf_dir):
    d = _split(spark, sf_dir)
    cols = ["totalprice", "bal", "sum_qty"]
    out, _ = transforms.standardize(d, cols, where=_train(), suffix="_z")
    return out.select("id", *[F.round(f"{c}_z", D).alias(f"{c}_z") for c in cols])


def standardize_all(spark, sf_dir):
    cols = ["totalprice", "bal", "sum_qty"]
    out, _ = transforms.standardize(mo(spark, sf_dir), cols, suffix="_z")
    return out.select("id", *[F.round(f"{c}_z", D).alias(f"{c}_z") for c in cols])


def dummy_full_rank(spark, sf_dir):
    d = _split(spark, sf_dir)
    levels = transforms.dummy_levels(d, ["segment", "status"], where=_train())
    out = transforms.add_dummies(d.select("id", "segment", "status"), levels, full_rank=True)
    return out.drop("segment", "status")


def missing_flags(spark, sf_dir):
    d = _split(spark, sf_dir)
    flags = transforms.missing_flag_columns(d, ["totalprice", *IMPUTE_COLS], where=_train())
    return transforms.add_missing_flags(d.select("id", *flags), flags).drop(*flags)


def impute_mean(spark, sf_dir):
    d = _split(spark, sf_dir)
    means = impute.fit_means(d, IMPUTE_COLS, where=_train())
    out = impute.apply_fill(d.select("id", *IMPUTE_COLS), means)
    return out.select("id", *[F.round(F.col(c).cast("double"), D).alias(c) for c in IMPUTE_COLS])


def impute_mode(spark, sf_dir):
    d = _split(spark, sf_dir)
    modes = impute.fit_modes(d, ["segment", "status", "order_month"], where=_train())
    filled = impute.apply_fill(d.select("segment", "status", "order_month"), modes)
    return filled.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


def impute_median(spark, sf_dir):
    d = mo(spark, sf_dir)
    qt = explore.quantile_table(d, IMPUTE_COLS, [0.5])
    return qt.select("col_name", F.round("q", D).alias("median"))


QUERIES = {
    "currency_parse": currency_parse,
    "cast_nominal": cast_nominal,
    "ordinal_rank": ordinal_rank,
    "level_collapse": level_collapse,
    "recode_default_null": recode_default_null,
    "hour_daypart": hour_daypart,
    "weighted_score": weighted_score,
    "log1p_cols": log1p_cols,
    "cutoff_class": cutoff_class,
    "poly_terms": poly_terms,
    "math_scalars": math_scalars,
    "boxcox_lambda": boxcox_lambda,
    "yeojohnson_lambda": yeojohnson_lambda,
    "yeojohnson_refined": yeojohnson_refined,
    "standardize_train": standardize_train,
    "standardize_all": standardize_all,
    "dummy_full_rank": dummy_full_rank,
    "missing_flags": missing_flags,
    "impute_mean": impute_mean,
    "impute_mode": impute_mode,
    "impute_median": impute_median,
}

_SPLIT = split_sql("target_s", 0.5, 42)
_LAMBDAS = ", lams AS (SELECT CAST(round(-2.0 + 0.1 * i, 1) AS DOUBLE) AS lam FROM (SELECT unnest(range(0, 41)) AS i))"


def _power_sql(src_sql: str, method: str) -> str:
    if method == "boxcox":
        y = "CASE WHEN lam = 0 THEN ln(v) ELSE (pow(v, lam) - 1) / lam END"
        jac = "ln(v)"
    else:
        y = ("CASE WHEN v >= 0 THEN (CASE WHEN lam = 0 THEN ln(1 + v) ELSE (pow(v + 1, lam) - 1) / lam END) "
             "ELSE (CASE WHEN lam = 2 THEN -ln(1 - v) ELSE -(pow(1 - v, 2 - lam) - 1) / (2 - lam) END) END")
        jac = "sign(v) * ln(1 + abs(v))"
    return f"""{_LAMBDAS},
x AS ({src_sql}),
j AS (SELECT col_name, count(*) AS n, sum({jac}) AS j FROM x GROUP BY col_name),
p AS (SELECT col_name, lam, var_pop({y}) AS v FROM x, lams GROUP BY col_name, lam),
ll AS (SELECT p.col_name, p.lam, j.n, -j.n / 2.0 * ln(p.v) + (p.lam - 1) * j.j AS loglik
       FROM p JOIN j ON p.col_name = j.col_name)
SELECT col_name, arg_max(lam, (loglik, -lam)) AS "lambda", any_value(n) AS n FROM ll GROUP BY col_name"""


_YJ = ("CASE WHEN v >= 0 THEN (CASE WHEN lam = 0 THEN ln(1 + v) ELSE (pow(v + 1, lam) - 1) / lam END) "
       "ELSE (CASE WHEN lam = 2 THEN -ln(1 - v) ELSE -(pow(1 - v, 2 - lam) - 1) / (2 - lam) END) END")
_YJ_REFINED_SQL = f"""WITH
x AS (SELECT 'c_acctbal' AS col_name, c_acctbal AS v FROM customer WHERE c_acctbal IS NOT NULL),
j AS (SELECT col_name, count(*) AS n, sum(sign(v) * ln(1 + abs(v))) AS j FROM x GROUP BY col_name),
lams AS (SELECT CAST(round(-2.0 + 0.1 * i, 1) AS DOUBLE) AS lam FROM (SELECT unnest(range(0, 41)) AS i)),
p1 AS (SELECT col_name, lam, var_pop({_YJ}) AS vv FROM x, lams GROUP BY col_name, lam),
b1 AS (SELECT p1.col_name, arg_max(p1.lam, (-j.n / 2.0 * ln(p1.vv) + (p1.lam - 1) * j.j, -p1.lam)) AS lam0
       FROM p1 JOIN j ON p1.col_name = j.col_name GROUP BY p1.col_name),
lams2 AS (SELECT b1.col_name, CAST(round(b1.lam0 + 0.01 * i, 6) AS DOUBLE) AS lam
          FROM b1, (SELECT unnest(range(-10, 11)) AS i)),
p2 AS (SELECT x.col_name, l.lam, var_pop({_YJ}) AS vv FROM x JOIN lams2 l ON x.col_name = l.col_name
       GROUP BY x.col_name, l.lam)
SELECT p2.col_name, round(arg_max(p2.lam, (-j.n / 2.0 * ln(p2.vv) + (p2.lam - 1) * j.j, -p2.lam)), 2) AS "lambda",
       any_value(j.n) AS n
FROM p2 JOIN j ON p2.col_name = j.col_name GROUP BY p2.col_name"""


def _z_sql(where: str) -> str:
    cols = ["totalprice", "bal", "sum_qty"]
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in cols)
    zs = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}_z" for c in cols)
    src = "split" if where else "mining_orders"
    return f", st AS (SELECT {stats} FROM {src} {where}) SELECT id, {zs} FROM {src}, st"


ORACLE = {
    "currency_parse": with_mo(" SELECT id, TRY_CAST(regexp_replace(price_text, '[$,]', '', 'g') AS DOUBLE) AS amount "
                              "FROM mining_orders"),
    "cast_nominal": with_mo(", lv AS (SELECT CAST(order_month AS VARCHAR) AS level, count(*) AS n FROM mining_orders "
                            "GROUP BY 1) SELECT level, n, CAST(row_number() OVER (ORDER BY level) AS INTEGER) AS level_order FROM lv"),
    "ordinal_rank": with_mo(" SELECT status, CASE status WHEN 'F' THEN 1 WHEN 'P' THEN 2 WHEN 'O' THEN 3 END AS "
                            "status_rank, count(*) AS n FROM mining_orders GROUP BY 1, 2"),
    "level_collapse": with_mo(" SELECT CASE segment WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'BUILDING' THEN 'HOME' "
                              "WHEN 'HOUSEHOLD' THEN 'HOME' WHEN 'MACHINERY' THEN 'INDUSTRY' END AS segment_group, "
                              "count(*) AS n FROM mining_orders GROUP BY 1"),
    "recode_default_null": "SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'HIGH' "
                           "WHEN '3-MEDIUM' THEN 'MEDIUM' END AS priority, count(*) AS n FROM orders GROUP BY 1",
    "hour_daypart": "SELECT CASE WHEN h BETWEEN 5 AND 11 THEN 'M' WHEN h BETWEEN 12 AND 16 THEN 'A' "
                    "WHEN h BETWEEN 17 AND 20 THEN 'E' WHEN h IS NOT NULL THEN 'N' END AS daypart, h AS hour, "
                    "count(*) AS n FROM (SELECT CAST(hour(ts) AS INTEGER) AS h FROM events) GROUP BY 1, 2",
    "weighted_score": "SELECT l_returnflag, round(avg(2.0/3 * l_discount + 1.0/3 * l_tax), 6) AS avg_score, "
                      "round(max(2.0/3 * l_discount + 1.0/3 * l_tax), 6) AS max_score FROM lineitem GROUP BY 1",
    "log1p_cols": with_mo(" SELECT id, round(ln(1 + totalprice), 6) AS totalprice, round(ln(1 + sum_qty), 6) AS sum_qty, "
                          "round(ln(1 + avg_price), 6) AS avg_price FROM mining_orders"),
    "cutoff_class": with_so(" SELECT CAST(count(*) FILTER (WHERE prob > 0.5) AS BIGINT) AS n_gt_050, "
                            "CAST(count(*) FILTER (WHERE prob >= 0.5) AS BIGINT) AS n_ge_050, "
                            "CAST(count(*) FILTER (WHERE prob > 0.3) AS BIGINT) AS n_gt_030, "
                            "CAST(count(*) FILTER (WHERE prob >= 0.3) AS BIGINT) AS n_ge_030 FROM scored_orders"),
    "poly_terms": with_mo(" SELECT id, round(totalprice * bal, 4) AS totalprice_x_bal, "
                          "round(totalprice * sum_qty, 4) AS totalprice_x_sum_qty, round(bal * sum_qty, 4) AS bal_x_sum_qty, "
                          "round(bal * bal, 4) AS bal_x_bal FROM mining_orders"),
    "math_scalars": with_so(" SELECT id, round(abs(prob - 0.2), 6) AS gap_02, "
                            "CASE WHEN prob > 0 AND prob < 1 THEN round(ln(prob / (1 - prob)), 6) END AS log_odds, "
                            "CASE WHEN prob > 0 AND prob < 1 THEN round(exp(ln(prob / (1 - prob))), 6) END AS odds "
                            "FROM scored_orders"),
    "boxcox_lambda": with_mo(_power_sql(
        "SELECT 'totalprice' AS col_name, totalprice AS v FROM mining_orders WHERE totalprice > 0 UNION ALL "
        "SELECT 'avg_price', avg_price FROM mining_orders WHERE avg_price > 0", "boxcox")),
    "yeojohnson_lambda": "WITH " + _power_sql(
        "SELECT 'c_acctbal' AS col_name, c_acctbal AS v FROM customer WHERE c_acctbal IS NOT NULL",
        "yeojohnson")[2:],
    "yeojohnson_refined": _YJ_REFINED_SQL,
    "standardize_train": with_mo(_SPLIT + _z_sql("WHERE split = 'train'")),
    "standardize_all": with_mo(_z_sql("")),
    "dummy_full_rank": with_mo(_SPLIT + " SELECT id, "
                               + ", ".join(f"CASE WHEN segment IS NULL THEN NULL WHEN segment = '{lv}' THEN 1 ELSE 0 END "
                                           f"AS segment_{lv}" for lv in ["BUILDING", "HOUSEHOLD", "MACHINERY"]) + ", "
                               + ", ".join(f"CASE WHEN status IS NULL THEN NULL WHEN status = '{lv}' THEN 1 ELSE 0 END "
                                           f"AS status_{lv}" for lv in ["O", "P"]) + " FROM split"),
    "missing_flags": with_mo(_SPLIT + " SELECT id, " + ", ".join(
        f"CAST({c} IS NULL AS INTEGER) AS {c}_NA" for c in IMPUTE_COLS) + " FROM split"),
    "impute_mean": with_mo(_SPLIT + ", m AS (SELECT " + ", ".join(f"avg({c}) AS {c}" for c in IMPUTE_COLS)
                           + " FROM split WHERE split = 'train') SELECT s.id, " + ", ".join(
        f"round(coalesce(CAST(s.{c} AS DOUBLE), m.{c}), 6) AS {c}" for c in IMPUTE_COLS) + " FROM split s, m"),
    "impute_mode": with_mo(_SPLIT + """,
md AS (SELECT min_by(segment, cnt_key) AS mode FROM (
         SELECT segment, (-count(*), segment) AS cnt_key FROM split WHERE split = 'train' AND segment IS NOT NULL
         GROUP BY segment))
SELECT coalesce(segment, (SELECT mode FROM md)) AS segment, count(*) AS n FROM split GROUP BY 1"""),
    "impute_median": with_mo(" SELECT col_name, round(q, 6) AS median FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, quantile_cont({c}, 0.5) AS q FROM mining_orders" for c in IMPUTE_COLS) + ")"),
}
