"""Feed-forward network classifier with warm-started rounds, early stopping on validation loss
and best-round checkpointing (N1-N4, S5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = 1e-15


def validation_metrics(model, valid: DataFrame, target: str) -> tuple[float, float]:
    """(log loss, accuracy) on validation rows: one aggregate."""
    s = model.transform(valid).select(F.col(target).cast("double").alias("y"),
                                      vector_to_array("probability")[1].alias("p"), "prediction")
    p = F.least(F.greatest(F.col("p"), F.lit(EPS)), F.lit(1 - EPS))
    row = s.agg(F.avg(-(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p))).alias("loss"),
                F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("acc")).first()
    return float(row["loss"]), float(row["acc"])


def fit_early_stopping(train: DataFrame, valid: DataFrame, target: str, hidden: Sequence[int],
                       n_inputs: int, iters_per_round: int = 5, max_rounds: int = 40, patience: int = 5,
                       monitor: str = "loss", seed: int = 1, features: str = "features",
                       checkpoint_path: str | None = None):
    """Train in rounds of `iters_per_round` optimizer steps, each round warm-started from the
    previous weights; keep the round with the best validation metric and stop after `patience`
    rounds without improvement. With `checkpoint_path`, every improvement is saved there and the
    best model is reloaded from it at the end (save-best-only checkpointing).
    Returns (best model, history [(round, loss, accuracy)], best round)."""
    layers = [n_inputs, *hidden, 2]
    weights = None
    best = None
    history = []
    stale = 0
    for r in range(1, max_rounds + 1):
        mlp = MultilayerPerceptronClassifier(layers=layers, maxIter=iters_per_round, seed=seed,
                                             labelCol=target, featuresCol=features)
        if weights is not None:
            mlp = mlp.setInitialWeights(weights)
        model = mlp.fit(train)
        weights = model.weights
        loss, acc = validation_metrics(model, valid, target)
        history.append((r, loss, acc))
        score = loss if monitor == "loss" else -acc
        if best is None or score < best[0] - 1e-12:
            best = (score, model, r)
            stale = 0
            if checkpoint_path:
                model.write().overwrite().save(checkpoint_path)
        else:
            stale += 1
            if stale >= patience:
                break
    if checkpoint_path:
        from pyspark.ml.classification import MultilayerPerceptronClassificationModel
        return MultilayerPerceptronClassificationModel.load(checkpoint_path), history, best[2]
    return best[1], history, best[2]
