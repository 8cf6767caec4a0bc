"""Minimum end-to-end slice: split, impute on train, flag, log, fixed logistic score, cutoff,
confusion and F1 per split."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.operators import evaluate, sampling, transforms
from quarry.operators.prep import FittedPrep
from quarry.plans.fixtures import MINING_ORDERS_SQL, mining_orders

SEED = 42
TRAIN_RATIO = 0.5
NUMERIC_INPUTS = ["totalprice", "bal", "n_lines", "sum_qty", "avg_price"]
# Fixed coefficients of the flagship score.
FLAG_INTERCEPT = -3.0
FLAG_COEFS = {"totalprice": 5.0 / 500000, "bal": 1.5 / 10000, "sum_qty": 0.2, "bal_NA": -0.3}
CUTOFF = 0.5


def prepared_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mining_orders + split + train-fitted mean imputation + missing flags + log1p(sum_qty)."""
    mo = mining_orders(spark, sf_dir)
    # The split table feeds three passes (flag check, means, scoring): keep it materialized.
    split = sampling.stratified_split(mo, "target_s", "id", (TRAIN_RATIO,), ("train", "valid"), SEED).persist(
        StorageLevel.MEMORY_AND_DISK)
    # Flag list and means come from one aggregate over the training rows.
    prep = FittedPrep.fit(split, NUMERIC_INPUTS, [], where=F.col("split") == "train")
    return transforms.log1p_columns(prep.transform(split), ["sum_qty"])


def flagship_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    prep = prepared_orders(spark, sf_dir)
    if "bal_NA" not in prep.columns:
        prep = prep.withColumn("bal_NA", F.lit(0))
    prob = fc.sigmoid(fc.linear_predictor(FLAG_COEFS, FLAG_INTERCEPT))
    scored = prep.select("split", F.col("target_s").alias("actual"),
                         fc.cutoff_class(prob, CUTOFF, strict=False).alias("pred_class"))
    cm = evaluate.confusion_counts(scored, group_cols=["split"])
    return evaluate.with_rates(cm)


FLAGSHIP_SQL = "WITH " + MINING_ORDERS_SQL + f""",
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY target_s ORDER BY md5(CAST(id AS VARCHAR) || '|{SEED}'), id) AS rk,
         count(*) OVER (PARTITION BY target_s) AS n_cls
  FROM mining_orders),
split AS (
  SELECT *, CASE WHEN rk <= floor({TRAIN_RATIO} * n_cls + 0.5) THEN 'train' ELSE 'valid' END AS split FROM ranked),
m AS (
  SELECT avg(bal) AS bal, avg(sum_qty) AS sum_qty FROM split WHERE split = 'train'),
prep AS (
  SELECT s.split, s.target_s AS actual, s.totalprice,
         coalesce(s.bal, m.bal) AS bal, ln(1 + coalesce(s.sum_qty, m.sum_qty)) AS sum_qty,
         CASE WHEN s.bal IS NULL THEN 1 ELSE 0 END AS bal_NA
  FROM split s, m),
scored AS (
  SELECT split, actual,
         CASE WHEN 1.0 / (1.0 + exp(-({FLAG_INTERCEPT} + {FLAG_COEFS['totalprice']!r} * totalprice
              + {FLAG_COEFS['bal']!r} * bal + {FLAG_COEFS['sum_qty']!r} * sum_qty + {FLAG_COEFS['bal_NA']!r} * bal_NA)))
              >= {CUTOFF} THEN 1 ELSE 0 END AS pred_class
  FROM prep),
cm AS (
  SELECT split,
         count(*) FILTER (WHERE actual = 1 AND pred_class = 1) AS tp,
         count(*) FILTER (WHERE actual = 0 AND pred_class = 1) AS fp,
         count(*) FILTER (WHERE actual = 1 AND pred_class = 0) AS fn,
         count(*) FILTER (WHERE actual = 0 AND pred_class = 0) AS tn
  FROM scored GROUP BY split)
SELECT split, tp, fp, fn, tn,
       round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS accuracy,
       round(1.0 - (tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS misclass,
       round(2.0 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) AS f1
FROM cm"""
