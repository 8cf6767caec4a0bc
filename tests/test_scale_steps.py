"""Steps whose cost must not grow with starts, failed casts or statistics: same results, fewer passes."""

import re

import numpy as np
import pytest
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from quarry.operators import cluster, logistic
from quarry.sources import csv


def _points(spark, n=400):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b)) for a, b in rng.normal(size=(n, 2)) + rng.integers(0, 4, (n, 1)) * 2.5]
    return cluster.assemble(spark.createDataFrame(rows, "a double, b double").coalesce(2), ["a", "b"])


def test_starts_share_their_iterations(spark, monkeypatch):
    d, seeds, real, full = _points(spark).persist(), list(range(11, 23)), cluster.fit_kmeans, []
    apart = [(real(d, 4, s).summary.trainingCost, i, s) for i, s in enumerate(seeds)]

    def counted(df, k, seed=1, max_iter=100, init_mode="random"):
        full.extend([seed] if max_iter else [])
        return real(df, k, seed, max_iter, init_mode)

    monkeypatch.setattr(cluster, "fit_kmeans", counted)
    model, cost, seed = cluster.multistart(d, 4, seeds)
    assert (cost, seed) == (min(apart)[0], min(apart)[2])
    assert len(full) < len(seeds) and seed in full


def test_shared_iterations_cost_what_separate_fits_cost(spark):
    d = _points(spark).persist()
    starts = [np.array(cluster.fit_kmeans(d, 4, s, 0).clusterCenters()) for s in (1, 2, 3)]
    for max_iter in (1, 2, 100):
        costs = cluster._lloyd_costs(d, starts, max_iter)
        assert costs == pytest.approx([cluster.fit_kmeans(d, 4, s, max_iter).summary.trainingCost for s in (1, 2, 3)])


def test_texts_are_told_apart_before_a_cast(spark):
    numbers = ["1", "-2.5", ".5", "+1e5", "1.", "inf", "-Infinity", "+INF", "NaN", "0x1p3", "5d", " 7", "\t8", "-.5f"]
    texts = ["$1,234.50", "BUILDING", "F", "x1", "-", "..5", ",1"]
    assert all(re.match(csv._NUMBER_START, n) for n in numbers)
    assert not any(re.match(csv._NUMBER_START, t) for t in texts)
    cast = spark.createDataFrame([(t,) for t in numbers + texts], "v string").select(
        F.col("v").rlike(csv._NUMBER_START).alias("begins"), F.col("v").try_cast("double").isNotNull().alias("number"))
    assert all(r["begins"] or not r["number"] for r in cast.collect())
    rows = spark.createDataFrame([("1", "1.5", "inf", "1x", None), (" 2 ", "2", "-.5", "3", None), ("", "", "nan", "4", None)],
                                 "a string, b string, c string, d string, e string")
    assert csv.infer_types(rows) == {"a": "bigint", "b": "double", "c": "double", "d": "string", "e": "bigint"}


def test_a_logistic_fit_passes_over_kept_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(float(x), int(x + e > 0)) for x, e in rng.normal(size=(300, 2))]
    train, kept, real = spark.createDataFrame(rows, "x double, y int"), [], GeneralizedLinearRegression.fit

    def fit(self, df):
        kept.append(df.storageLevel.useMemory)
        return real(self, df)

    monkeypatch.setattr(GeneralizedLinearRegression, "fit", fit)
    found = logistic.fit_logit(train, "y", {"x": ["x"]}, ["x"])
    assert kept == [True] and found.n == 300 and found.coefs[0] > 0
