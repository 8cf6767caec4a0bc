"""Model evaluation over a scored table (actual 0/1, prob, class): E1-E12.

All statistics are conditional counts over the table; curve statistics (ROC, lift, AUC) first
collapse rows to distinct scores and then take exact running totals per score bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import col_
from quarry.operators.ranking import with_running_totals


def confusion_counts(df: DataFrame, actual: str = "actual", predicted: str = "pred_class",
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn (zero-filled) per group: one aggregate."""
    a, p = F.col(actual), F.col(predicted)
    aggs = [F.count_if((a == 1) & (p == 1)).alias("tp"),
            F.count_if((a == 0) & (p == 1)).alias("fp"),
            F.count_if((a == 1) & (p == 0)).alias("fn"),
            F.count_if((a == 0) & (p == 0)).alias("tn")]
    return df.groupBy(*group_cols).agg(*aggs)


def _safe_div(n: Column, d: Column) -> Column:
    return F.when(d != 0, n.cast("double") / d)


def f1_expr(tp="tp", fp="fp", fn="fn") -> Column:
    tp, fp, fn = col_(tp), col_(fp), col_(fn)
    return _safe_div(2 * tp, 2 * tp + fp + fn)


def accuracy_expr(tp="tp", fp="fp", fn="fn", tn="tn") -> Column:
    tp, fp, fn, tn = col_(tp), col_(fp), col_(fn), col_(tn)
    return _safe_div(tp + tn, tp + fp + fn + tn)


def with_rates(cm: DataFrame, digits: int = 6) -> DataFrame:
    """Add accuracy, misclassification and F1 of the event to a confusion-count table."""
    return cm.select("*",
                     F.round(accuracy_expr(), digits).alias("accuracy"),
                     F.round(F.lit(1.0) - accuracy_expr(), digits).alias("misclass"),
                     F.round(f1_expr(), digits).alias("f1"))


def confusion_stats(cm: DataFrame, digits: int = 6) -> DataFrame:
    """Full statistics of a confusion-count row (event = 1): accuracy, no-information rate, kappa,
    McNemar statistic (continuity-corrected), sensitivity, specificity, PPV, NPV, precision,
    recall, F1, prevalence, detection rate/prevalence, balanced accuracy."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    acc = _safe_div(tp + tn, n)
    prev = _safe_div(tp + fn, n)
    pe = _safe_div((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    sens = _safe_div(tp, tp + fn)
    spec = _safe_div(tn, tn + fp)
    stats = {
        "accuracy": acc,
        "nir": F.greatest(prev, F.lit(1.0) - prev),
        "kappa": F.try_divide(acc - pe, F.lit(1.0) - pe),
        "mcnemar_stat": _safe_div(F.pow(F.abs(fp - fn) - 1, 2), fp + fn),
        "sensitivity": sens,
        "specificity": spec,
        "ppv": _safe_div(tp, tp + fp),
        "npv": _safe_div(tn, tn + fn),
        "f1": f1_expr(tp, fp, fn),
        "prevalence": prev,
        "detection_rate": _safe_div(tp, n),
        "detection_prevalence": _safe_div(tp + fp, n),
        "balanced_accuracy": (sens + spec) / 2,
    }
    return cm.select("*", *[F.round(v, digits).alias(k) for k, v in stats.items()])


def score_counts(df: DataFrame, prob: str = "prob", actual: str = "actual") -> DataFrame:
    """Distinct scores with event / non-event counts (map-side combined)."""
    return df.groupBy(F.col(prob).alias("score")).agg(
        F.sum(F.col(actual).cast("long")).alias("pos"),
        F.sum((1 - F.col(actual)).cast("long")).alias("neg"))


def roc_points(df: DataFrame, prob: str = "prob", actual: str = "actual") -> DataFrame:
    """One ROC point per distinct score s: classify prob >= s. (cutoff, tp, fp, sensitivity, specificity)."""
    cum = with_running_totals(score_counts(df, prob, actual), "score", {"tp": F.col("pos"), "fp": F.col("neg")},
                              descending=True, persist_input=True, group_totals=True)
    return cum.select(F.col("score").alias("cutoff"), "tp", "fp",
                      F.try_divide(F.col("tp"), F.col("tp_total")).alias("sensitivity"),
                      (F.lit(1.0) - F.try_divide(F.col("fp"), F.col("fp_total"))).alias("specificity"))


def auc(df: DataFrame, prob: str = "prob", actual: str = "actual") -> DataFrame:
    """Exact AUC with ties counted one half: sum_k pos_k * (neg below s_k + neg_k / 2) / (P * N)."""
    cum = with_running_totals(score_counts(df, prob, actual), "score", {"neg_le": F.col("neg")}, persist_input=True)
    below = F.col("neg_le") - F.col("neg")
    sums = cum.agg(F.sum(F.col("pos") * (below + F.col("neg") / 2.0)).alias("won"),
                   F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return sums.select(F.try_divide(F.col("won"), pairs).alias("auc"), "n_pos", "n_neg")


def best_cutoff_topleft(roc: DataFrame) -> DataFrame:
    """Cutoff closest to the top-left corner; ties -> smallest cutoff."""
    d = F.pow(1 - F.col("sensitivity"), 2) + F.pow(1 - F.col("specificity"), 2)
    return roc.agg(F.min_by("cutoff", F.struct(d, F.col("cutoff"))).alias("cutoff"), F.min(d).alias("distance"))


def lift_curve(df: DataFrame, prob: str = "prob", actual: str = "actual") -> DataFrame:
    """(cutoff, rpp, lift): rate of positive predictions and precision / prevalence per distinct score."""
    cum = with_running_totals(score_counts(df, prob, actual), "score",
                              {"tp": F.col("pos"), "k": F.col("pos") + F.col("neg")},
                              descending=True, persist_input=True, group_totals=True)
    precision, prevalence = F.col("tp") / F.col("k"), F.col("tp_total") / F.col("k_total")
    return cum.select(F.col("score").alias("cutoff"), (F.col("k") / F.col("k_total")).alias("rpp"),
                      F.try_divide(precision, prevalence).alias("lift"))


def lift_at(curve: DataFrame, depth: float = 0.2) -> DataFrame:
    """Lift at the rpp nearest to `depth` (ties -> smaller rpp)."""
    key = F.struct(F.abs(F.col("rpp") - F.lit(depth)), F.col("rpp"))
    return curve.agg(F.min_by("lift", key).alias("lift"), F.min_by("rpp", key).alias("rpp"))


def profit_cutoff(pmatrix: Sequence[Sequence[float]]) -> float:
    """Bayes cutoff of a 2x2 profit matrix (rows actual, columns predicted, event first)."""
    num = pmatrix[1][1] - pmatrix[1][0]
    den = num - (pmatrix[0][1] - pmatrix[0][0])
    return num / den


def avg_profit(df: DataFrame, pmatrix: Sequence[Sequence[float]], prob: str = "prob",
               actual: str = "actual", group_cols: Sequence[str] = ()) -> DataFrame:
    """Average profit per case with class = prob >= the matrix's cutoff."""
    cut = profit_cutoff(pmatrix)
    a, c = F.col(actual), F.col(prob) >= F.lit(cut)
    cell = (F.when((a == 1) & c, pmatrix[0][0]).when((a == 1) & ~c, pmatrix[0][1])
            .when((a == 0) & c, pmatrix[1][0]).otherwise(pmatrix[1][1]))
    return df.groupBy(*group_cols).agg(F.lit(cut).alias("cutoff"), F.avg(cell).alias("avg_profit"))


def confusion_inference(cm: DataFrame, level: float = 0.95) -> DataFrame:
    """Accuracy with its exact binomial interval, P(accuracy > no-information rate) and the McNemar
    p-value, from a one-row confusion-count table (the counts are the only data brought back)."""
    from quarry.functions import pvalues
    r = cm.first()
    tp, fp, fn, tn = (int(r[c]) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    correct = tp + tn
    lo, hi = pvalues.binom_ci(correct, n, level) if n else (float("nan"), float("nan"))
    prev = (tp + fn) / n if n else float("nan")
    nir = max(prev, 1 - prev) if n else float("nan")
    p_nir = pvalues.binom_upper_tail(correct, n, nir) if n else float("nan")
    mc = (abs(fp - fn) - 1) ** 2 / (fp + fn) if fp + fn else float("nan")
    p_mc = pvalues.chi2_sf(mc, 1) if fp + fn else float("nan")
    row = [(n, correct / n if n else float("nan"), lo, hi, nir, p_nir, mc, p_mc)]
    return cm.sparkSession.createDataFrame(
        row, "n long, accuracy double, acc_ci_low double, acc_ci_high double, nir double, p_acc_gt_nir double, "
             "mcnemar_stat double, mcnemar_p double")


def best_cutoff_midpoint(scored: DataFrame, prob: str = "prob", actual: str = "actual") -> float:
    """Top-left best cutoff reported as the midpoint between the chosen score and the next lower
    distinct score (the lowest score keeps its own value): the threshold a new row is compared to."""
    best = best_cutoff_topleft(roc_points(scored, prob, actual)).first()["cutoff"]
    lower = scored.filter(F.col(prob) < F.lit(best)).agg(F.max(prob).alias("m")).first()["m"]
    return best if lower is None else (best + lower) / 2.0
