"""Random forests (R1-R5, M5): fit, error by number of trees, importance, mtry tuning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_forest(train: DataFrame, target: str, n_trees: int = 50, mtry: int | str = "sqrt",
               max_depth: int = 12, weight_col: str | None = None, seed: int = 1,
               features: str = "features", min_instances: int = 1) -> RandomForestClassificationModel:
    """`mtry` is the number of inputs tried per split (an integer) or a Spark strategy name.

    A balanced per-tree sample (strata + equal sample sizes) has no Spark parameter; class balance
    is given by `weight_col` (inverse class prior) instead.
    """
    # Node ids cached per row (checkpointed every 10 levels to the shared checkpoint folder) save
    # re-walking deep trees on every pass; a larger node-statistics budget splits more nodes per pass.
    rf = RandomForestClassifier(labelCol=target, featuresCol=features, numTrees=n_trees,
                                featureSubsetStrategy=str(mtry), maxDepth=max_depth, seed=seed,
                                minInstancesPerNode=min_instances, cacheNodeIds=True, maxMemoryInMB=1024,
                                checkpointInterval=10)
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    return rf.fit(train)


def event_probability(model, df: DataFrame, out: str = "pred_prob") -> DataFrame:
    """P(event) per row (second element of the probability vector)."""
    return model.transform(df).withColumn(out, vector_to_array("probability")[1])


def error_by_trees(model: RandomForestClassificationModel, valid: DataFrame, target: str,
                   ks: Sequence[int]) -> DataFrame:
    """Validation misclassification of the forest made of its first k trees, for each k.

    Every tree adds its P(event) column in one projection; running means over trees give the
    k-tree vote, so the validation rows are read once.
    """
    trees = model.trees
    kmax = max(ks)
    cur = valid.select(F.col(target).alias("__y"), model.getFeaturesCol())
    for i, t in enumerate(trees[:kmax]):
        t = t.copy().setPredictionCol(f"__p{i}").setRawPredictionCol(f"__r{i}").setProbabilityCol(f"__q{i}")
        cur = t.transform(cur).withColumn(f"__e{i}", vector_to_array(f"__q{i}")[1]).drop(
            f"__p{i}", f"__r{i}", f"__q{i}")
    errs = []
    total = None
    for i in range(kmax):
        total = F.col(f"__e{i}") if total is None else total + F.col(f"__e{i}")
        if i + 1 in ks:
            wrong = ((total / (i + 1) > 0.5).cast("int") != F.col("__y")).cast("double")
            errs.append(F.avg(wrong).alias(f"k{i + 1}"))
    row = cur.agg(*errs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("n_trees"), F.col(f"k{k}").alias("valid_error")) for k in sorted(ks)
    ])).alias("e")).select("e.*")


def importance_rows(model, names: Sequence[str]) -> list[tuple[str, float]]:
    imp = model.featureImportances.toArray()
    return sorted(((n, float(v)) for n, v in zip(names, imp)), key=lambda x: (-x[1], x[0]))


def tune_mtry(train: DataFrame, valid: DataFrame, target: str, grid: Sequence[int], n_trees: int = 50,
              seed: int = 1, weight_col: str | None = None, **kw):
    """Fit one forest per mtry and keep the one with the best validation F1 (ties -> smaller mtry)."""
    from quarry.operators import evaluate
    results = []
    for m in grid:
        model = fit_forest(train, target, n_trees, m, seed=seed, weight_col=weight_col, **kw)
        scored = model.transform(valid).select(F.col(target).alias("actual"),
                                               F.col("prediction").cast("int").alias("pred_class"))
        cm = evaluate.confusion_counts(scored).select(evaluate.f1_expr().alias("f1")).first()
        results.append((m, float(cm["f1"] or 0.0), model))
    best = min(results, key=lambda r: (-r[1], r[0]))
    return best, [(m, f) for m, f, _ in results]


def permute_column(df: DataFrame, col: str, key: str, seed: int) -> DataFrame:
    """Column `col` shuffled across rows, reproducibly: the value of the row ranked r in key order
    moves to the row ranked r in md5(key|seed|col) order. Both ranks are exact and distributed
    (bucketed running counts), and the two sides meet in an equi-join on the rank."""
    from quarry.operators.ranking import hash_prefix_bucket, with_running_totals
    one = {"__r": F.lit(1).cast("long")}
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}|{col}")))
    dest = with_running_totals(df.withColumn("__h", h), "__h", one, tie_cols=[key],
                               bucket=hash_prefix_bucket(F.col("__h"))).drop("__h", col)
    src = with_running_totals(df.select(key, col).withColumn("__h", F.md5(F.col(key).cast("string"))), "__h", one,
                              tie_cols=[key], bucket=hash_prefix_bucket(F.col("__h")))
    src = src.select(F.col("__r"), F.col(col))
    return dest.join(src, "__r").drop("__r")


def permutation_importance(model, valid: DataFrame, target: str, feature_cols: Sequence[str], key: str,
                           seed: int = 1) -> list[tuple[str, float]]:
    """Accuracy drop on validation rows when one input column is permuted (features re-assembled)."""
    from pyspark.ml.feature import VectorAssembler
    fcol = model.getFeaturesCol()
    base_rows = valid.drop(fcol)

    def accuracy(d):
        scored = model.transform(VectorAssembler(inputCols=list(feature_cols), outputCol=fcol).transform(d))
        return scored.agg(F.avg((F.col("prediction") == F.col(target)).cast("double")).alias("a")).first()["a"]

    base = accuracy(base_rows)
    out = []
    for c in feature_cols:
        out.append((c, float(base - accuracy(permute_column(base_rows, c, key, seed)))))
    return sorted(out, key=lambda x: (-x[1], x[0]))


def balanced_ensemble(train: DataFrame, target: str, key: str, n_models: int = 5, trees_per_model: int = 10,
                      mtry: int | str = "sqrt", seed: int = 1, **kw) -> list:
    """Forests each grown on its own class-balanced down-sample (majority cut to the minority size,
    a different seeded hash order per model): every tree sees a balanced sample, as with a
    stratified per-tree sample size. Score with `ensemble_probability`."""
    from quarry.operators.sampling import downsample
    models = []
    for i in range(n_models):
        sample = downsample(train, target, key, seed=seed + 1000 * (i + 1))
        models.append(fit_forest(sample, target, trees_per_model, mtry, seed=seed + i, **kw))
    return models


def ensemble_probability(models: Sequence, df: DataFrame, out: str = "pred_prob") -> DataFrame:
    """Mean P(event) over the models: each adds one column in the same projection."""
    cur = df
    cols = []
    for i, m in enumerate(models):
        m = m.copy().setPredictionCol(f"__ep{i}").setRawPredictionCol(f"__er{i}").setProbabilityCol(f"__eq{i}")
        cur = m.transform(cur).withColumn(f"__e{i}", vector_to_array(f"__eq{i}")[1]).drop(
            f"__ep{i}", f"__er{i}", f"__eq{i}")
        cols.append(f"__e{i}")
    mean = sum((F.col(c) for c in cols[1:]), F.col(cols[0])) / F.lit(float(len(cols)))
    return cur.withColumn(out, mean).drop(*cols)
