"""Queries for model evaluation over `scored_orders`."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.operators import evaluate
from quarry.plans.common import so, with_so
from quarry.plans.fixtures import PRICE_SCALE

D = 6
PROFIT = [[0.55, 0.0], [-0.45, 0.0]]       # rows actual (1, 0), columns predicted (1, 0)


def _classed(spark, sf_dir, cutoff=0.5):
    return so(spark, sf_dir).withColumn("pred_class", fc.cutoff_class("prob", cutoff))


def confusion(spark, sf_dir):
    return evaluate.confusion_counts(_classed(spark, sf_dir))


def confusion_stats(spark, sf_dir):
    return evaluate.confusion_stats(evaluate.confusion_counts(_classed(spark, sf_dir)), D)


def confusion_inference(spark, sf_dir):
    return evaluate.confusion_inference(evaluate.confusion_counts(_classed(spark, sf_dir)))


def f1(spark, sf_dir):
    return evaluate.with_rates(evaluate.confusion_counts(_classed(spark, sf_dir)), D).select("f1", "misclass",
                                                                                             "accuracy")


def misclass_compare(spark, sf_dir):
    """Three scorers stacked under a `model` key and compared in one grouped aggregate."""
    s = so(spark, sf_dir)
    price_only = fc.sigmoid(F.lit(-2.5) + F.lit(5.0) * F.col("totalprice") / F.lit(PRICE_SCALE))
    from quarry.plans.fixtures import mining_orders
    mo = mining_orders(spark, sf_dir).select("id", "totalprice")
    base = s.join(mo, "id")
    prevalence = F.lit(0.0)
    stacked = base.select(F.explode(F.array(
        F.struct(F.lit("logit").alias("model"), F.col("prob").alias("p")),
        F.struct(F.lit("price").alias("model"), F.round(price_only, D).alias("p")),
        F.struct(F.lit("root").alias("model"), prevalence.alias("p")))).alias("m"), "actual")
    stacked = stacked.select("m.model", "actual", fc.cutoff_class("m.p", 0.5).alias("pred_class"))
    cm = evaluate.confusion_counts(stacked, group_cols=["model"])
    return evaluate.with_rates(cm, D).select("model", "misclass", "f1")


def profit_compare(spark, sf_dir):
    """Average profit per case of the three stacked scorers under one profit matrix."""
    s = so(spark, sf_dir)
    price_only = fc.sigmoid(F.lit(-2.5) + F.lit(5.0) * F.col("totalprice") / F.lit(PRICE_SCALE))
    from quarry.plans.fixtures import mining_orders
    base = s.join(mining_orders(spark, sf_dir).select("id", "totalprice"), "id")
    stacked = base.select(F.explode(F.array(
        F.struct(F.lit("logit").alias("model"), F.col("prob").alias("p")),
        F.struct(F.lit("price").alias("model"), F.round(price_only, D).alias("p")),
        F.struct(F.lit("root").alias("model"), F.lit(0.0).alias("p")))).alias("m"), "actual")
    stacked = stacked.select("m.model", "actual", F.col("m.p").alias("prob"))
    p = evaluate.avg_profit(stacked, PROFIT, group_cols=["model"])
    return p.select("model", F.round("avg_profit", D).alias("avg_profit"))


def roc_points(spark, sf_dir):
    r = evaluate.roc_points(so(spark, sf_dir))
    return r.select("cutoff", "tp", "fp", F.round("sensitivity", D).alias("sensitivity"),
                    F.round("specificity", D).alias("specificity"))


def auc(spark, sf_dir):
    return evaluate.auc(so(spark, sf_dir)).select(F.round("auc", D).alias("auc"), "n_pos", "n_neg")


def best_cutoff(spark, sf_dir):
    b = evaluate.best_cutoff_topleft(evaluate.roc_points(so(spark, sf_dir)))
    return b.select("cutoff", F.round("distance", D).alias("distance"))


def best_cutoff_mid(spark, sf_dir):
    cut = evaluate.best_cutoff_midpoint(so(spark, sf_dir))
    return spark.range(1).select(F.round(F.lit(cut), D).alias("cutoff"))


def lift_curve(spark, sf_dir):
    c = evaluate.lift_curve(so(spark, sf_dir))
    return c.select("cutoff", F.round("rpp", D).alias("rpp"), F.round("lift", D).alias("lift"))


def lift_at_20(spark, sf_dir):
    c = evaluate.lift_at(evaluate.lift_curve(so(spark, sf_dir)), 0.2)
    return c.select(F.round("lift", D).alias("lift"), F.round("rpp", D).alias("rpp"))


def avg_profit(spark, sf_dir):
    p = evaluate.avg_profit(so(spark, sf_dir), PROFIT)
    return p.select(F.round("cutoff", D).alias("cutoff"), F.round("avg_profit", D).alias("avg_profit"))


QUERIES = {
    "confusion": confusion,
    "confusion_stats": confusion_stats,
    "confusion_inference": confusion_inference,
    "f1": f1,
    "misclass_compare": misclass_compare,
    "profit_compare": profit_compare,
    "roc_points": roc_points,
    "auc": auc,
    "best_cutoff": best_cutoff,
    "best_cutoff_mid": best_cutoff_mid,
    "lift_curve": lift_curve,
    "lift_at_20": lift_at_20,
    "avg_profit": avg_profit,
}

_CM = """, c AS (SELECT actual, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS pred_class FROM scored_orders),
cm AS (SELECT count(*) FILTER (WHERE actual = 1 AND pred_class = 1) AS tp,
              count(*) FILTER (WHERE actual = 0 AND pred_class = 1) AS fp,
              count(*) FILTER (WHERE actual = 1 AND pred_class = 0) AS fn,
              count(*) FILTER (WHERE actual = 0 AND pred_class = 0) AS tn FROM c)"""

_CUM = """, d AS (SELECT prob AS score, CAST(sum(actual) AS BIGINT) AS pos, CAST(sum(1 - actual) AS BIGINT) AS neg
           FROM scored_orders GROUP BY prob),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM d),
cum AS (SELECT score, pos, neg, CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
               CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
               CAST(sum(neg) OVER (ORDER BY score) AS BIGINT) AS neg_le FROM d),
roc AS (SELECT score AS cutoff, tp, fp, tp / P AS sensitivity, 1 - fp / N AS specificity,
               (tp + fp) / (P + N) AS rpp, (tp / (tp + fp)) / (P / (P + N)) AS lift FROM cum, t)"""

_STATS = """SELECT tp, fp, fn, tn,
  round((tp + tn) / n, 6) AS accuracy, round(greatest(prev, 1 - prev), 6) AS nir,
  round(((tp + tn) / n - pe) / (1 - pe), 6) AS kappa,
  round(CASE WHEN fp + fn > 0 THEN pow(abs(fp - fn) - 1, 2) / (fp + fn) END, 6) AS mcnemar_stat,
  round(tp / (tp + fn), 6) AS sensitivity, round(tn / (tn + fp), 6) AS specificity,
  round(tp / (tp + fp), 6) AS ppv, round(tn / (tn + fn), 6) AS npv,
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(prev, 6) AS prevalence,
  round(tp / n, 6) AS detection_rate, round((tp + fp) / n, 6) AS detection_prevalence,
  round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy
FROM (SELECT tp, fp, fn, tn, CAST(tp + fp + fn + tn AS DOUBLE) AS n,
             (tp + fn) / CAST(tp + fp + fn + tn AS DOUBLE) AS prev,
             ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / pow(CAST(tp + fp + fn + tn AS DOUBLE), 2) AS pe
      FROM cm)"""

ORACLE = {
    "profit_compare": with_so(f""", s AS (SELECT so.actual, so.prob, mo.totalprice FROM scored_orders so
                                 JOIN mining_orders mo ON so.id = mo.id),
st AS (SELECT 'logit' AS model, actual, prob AS p FROM s
       UNION ALL SELECT 'price', actual, round(1.0 / (1.0 + exp(-(-2.5 + 5.0 * totalprice / {PRICE_SCALE}))), 6) FROM s
       UNION ALL SELECT 'root', actual, 0.0 FROM s)
SELECT model, round(avg(CASE WHEN actual = 1 AND p >= 0.45 THEN 0.55 WHEN actual = 1 THEN 0.0
                             WHEN p >= 0.45 THEN -0.45 ELSE 0.0 END), 6) AS avg_profit FROM st GROUP BY model"""),
    "confusion": with_so(_CM + " SELECT * FROM cm"),
    "confusion_stats": with_so(_CM + " " + _STATS),
    "f1": with_so(_CM + " SELECT round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1, "
                  "round(1 - (tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS misclass, "
                  "round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS accuracy FROM cm"),
    "misclass_compare": with_so(f""", s AS (SELECT so.actual, so.prob, mo.totalprice FROM scored_orders so
                                   JOIN mining_orders mo ON so.id = mo.id),
st AS (SELECT 'logit' AS model, actual, prob AS p FROM s
       UNION ALL SELECT 'price', actual, round(1.0 / (1.0 + exp(-(-2.5 + 5.0 * totalprice / {PRICE_SCALE}))), 6) FROM s
       UNION ALL SELECT 'root', actual, 0.0 FROM s),
cm AS (SELECT model, count(*) FILTER (WHERE actual = 1 AND p >= 0.5) AS tp, count(*) FILTER (WHERE actual = 0 AND p >= 0.5) AS fp,
              count(*) FILTER (WHERE actual = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE actual = 0 AND p < 0.5) AS tn
       FROM st GROUP BY model)
SELECT model, round(1 - (tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS misclass,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM cm"""),
    "roc_points": with_so(_CUM + " SELECT cutoff, tp, fp, round(sensitivity, 6) AS sensitivity, "
                          "round(specificity, 6) AS specificity FROM roc"),
    "auc": with_so(_CUM + " SELECT round(sum(pos * ((neg_le - neg) + neg / 2.0)) / (any_value(P) * any_value(N)), 6) AS auc, "
                   "CAST(any_value(P) AS BIGINT) AS n_pos, CAST(any_value(N) AS BIGINT) AS n_neg FROM cum, t"),
    "best_cutoff": with_so(_CUM + " SELECT arg_min(cutoff, (pow(1 - sensitivity, 2) + pow(1 - specificity, 2), cutoff)) "
                           "AS cutoff, round(min(pow(1 - sensitivity, 2) + pow(1 - specificity, 2)), 6) AS distance FROM roc"),
    "best_cutoff_mid": with_so(_CUM + """, b AS (SELECT arg_min(cutoff, (pow(1 - sensitivity, 2) + pow(1 - specificity, 2), cutoff))
                                      AS s FROM roc)
SELECT round(CASE WHEN l.m IS NULL THEN b.s ELSE (b.s + l.m) / 2 END, 6) AS cutoff
FROM b, (SELECT max(prob) AS m FROM scored_orders WHERE prob < (SELECT s FROM b)) l"""),
    "lift_curve": with_so(_CUM + " SELECT cutoff, round(rpp, 6) AS rpp, round(lift, 6) AS lift FROM roc"),
    "lift_at_20": with_so(_CUM + " SELECT round(arg_min(lift, (abs(rpp - 0.2), rpp)), 6) AS lift, "
                          "round(arg_min(rpp, (abs(rpp - 0.2), rpp)), 6) AS rpp FROM roc"),
    "avg_profit": with_so(" SELECT CAST(0.45 AS DOUBLE) AS cutoff, round(avg(CASE WHEN actual = 1 AND prob >= 0.45 THEN 0.55 "
                          "WHEN actual = 1 THEN 0.0 WHEN prob >= 0.45 THEN -0.45 ELSE 0.0 END), 6) AS avg_profit "
                          "FROM scored_orders"),
}
