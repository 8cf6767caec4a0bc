"""The network: gradients against differences, training against plain numpy, scoring against the forward pass."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import network as N
from quarry.operators.prep import FittedPrep
from quarry.operators.scoring import ScoringPipeline
from quarry.sources.bundle import load_bundle, save_bundle


@pytest.mark.parametrize("hidden", [[4], [4, 4], [6, 6]])
def test_gradient_equals_numeric_differences(hidden):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(40, 5)), rng.integers(0, 2, 40).astype(float)
    sizes = [5, *hidden, 1]
    flat = N.start_weights(sizes, 1) + rng.normal(size=len(N.start_weights(sizes, 1))) * 0.1
    got = N.gradient(x, y, flat, sizes)
    for i in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        want = (N.losses(x, y, up, sizes)[0] - N.losses(x, y, down, sizes)[0]) / 2e-6
        assert got[i] == pytest.approx(want, abs=1e-5)


def frame(spark, n=600, seed=5):
    """Class 1 inside a ring around the origin: no straight line separates it."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.uniform(-2, 2), rng.uniform(-2, 2)
        rows.append((i, a, b * 100 + 7, int(a * a + b * b < 1.6)))
    return spark.createDataFrame(rows, "id long, a double, b double, y int")


def test_training_equals_plain_numpy(spark):
    df = frame(spark, 200)
    net, history, best = N.fit_network(df, df, "y", "id", ["a", "b"], [3], epochs=4, steps=3, seed=2, patience=None)
    rows = df.withColumn("s", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(3))).collect()
    x = np.array([[r.a, r.b] for r in rows])
    x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    y, s = np.array([float(r.y) for r in rows]), np.array([r.s for r in rows])
    sizes, rng = [2, 3, 1], np.random.default_rng(2)
    flat = N.start_weights(sizes, 2)
    m, v, t, seen = 0.0, 0.0, 0, []
    for _ in range(4):
        for k in rng.permutation(3):
            g = N.gradient(x[s == k], y[s == k], flat, sizes) / (s == k).sum()
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            flat = flat - 0.03 * math.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * m / (np.sqrt(v) + 1e-7)
        seen.append((N.losses(x, y, flat, sizes)[0] / 200, flat))
    assert [h[1] for h in history] == pytest.approx([l for l, _ in seen], abs=1e-5)
    assert net.flat == pytest.approx(seen[best - 1][1].tolist(), abs=1e-5)
    assert best == 1 + int(np.argmin([l for l, _ in seen]))


def test_partitions_and_tasks_do_not_change_the_network(spark, monkeypatch):
    df = frame(spark, 300)
    a = N.fit_network(df.repartition(1), df, "y", "id", ["a", "b"], [4], epochs=3)[0]
    b = N.fit_network(df.repartition(23), df, "y", "id", ["a", "b"], [4], epochs=3)[0]
    assert a.flat == pytest.approx(b.flat, abs=1e-5)
    monkeypatch.setattr(N, "TASK_ROWS", 1)
    monkeypatch.setattr(N, "FEW_TASKS", 0)
    c = N.fit_network(df.repartition(23), df, "y", "id", ["a", "b"], [4], epochs=3)[0]
    assert c.flat == pytest.approx(a.flat, abs=1e-5)


def test_learns_what_no_line_separates_and_keeps_the_best_epoch(spark, tmp_path):
    df = frame(spark)
    train, valid = df.filter("id % 2 = 0"), df.filter("id % 2 = 1")
    net, history, best = N.fit_network(train, valid, "y", "id", ["a", "b"], [6, 6], patience=5, rate=0.05,
                                       checkpoint_path=str(tmp_path / "best"))
    by_loss = min(history, key=lambda h: h[1])
    assert best == by_loss[0] and by_loss[2] > 0.9
    assert len(history) in (40, best + 5)
    loss, accuracy = N.evaluate(net, valid, "y")
    assert loss == pytest.approx(by_loss[1], abs=1e-6) and accuracy == pytest.approx(by_loss[2])
    assert N.Network.load(spark, str(tmp_path / "best")) == net


def test_scores_equal_forward_pass_also_from_a_bundle(spark, tmp_path):
    df = frame(spark, 50).withColumn("__layer", F.lit("mine"))
    net, _, _ = N.fit_network(df, df, "y", "id", ["a", "b"], [4, 3], epochs=2)
    got = net.transform(df)
    assert got.columns == ["id", "a", "b", "y", "__layer", "pred_prob"]
    for r in got.collect():
        x = (np.array([[r.a, r.b]]) - net.center) / net.spread
        z = N.forward(x, np.array(net.flat), net.sizes)[-1][0, 0]
        assert r.pred_prob == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)
        assert r["__layer"] == "mine"
    pipe = ScoringPipeline(FittedPrep.fit(df, ["a", "b"], []), ["a", "b"], "network", cutoff=0.3, model=net)
    save_bundle(spark, pipe, str(tmp_path / "bundle"))
    again = load_bundle(spark, str(tmp_path / "bundle")).transform(df)
    assert {r.id: r.pred_prob for r in again.collect()} == {r.id: r.pred_prob for r in got.collect()}


def test_edge_cases(spark):
    rows = [(1, 1.0, 5.0, 0), (2, None, 5.0, 1), (3, float("nan"), 5.0, 1), (4, 2.0, 5.0, 1), (4, 2.0, 5.0, 1),
            (5, 0.5, 5.0, None), (None, 1.5, 5.0, 0), (6, float("inf"), 5.0, 0), (7, 3.0, 5.0, 2)]
    df = spark.createDataFrame(rows, "id long, a double, `b.c` double, y int")
    net, history, _ = N.fit_network(df, df, "y", "id", ["a", "b.c"], [2], epochs=2)
    assert net.center == pytest.approx([(1 + 2 + 2 + 1.5) / 4, 5.0]) and net.spread[1] == 1.0
    scores = [(r.id, r.pred_prob) for r in net.transform(df).collect()]
    assert sorted((i for i, p in scores if p is None)) == [2, 3, 6] and len(scores) == 9
    with pytest.raises(ValueError):
        N.fit_network(df.limit(0), df, "y", "id", ["a"], [2])
    with pytest.raises(ValueError):
        N.fit_network(df, df.limit(0), "y", "id", ["a"], [2])
    assert net.transform(df.limit(0)).count() == 0
