"""Batched candidate fits against one fit per candidate."""

import math
import random

import numpy as np
import pytest

from quarry.operators import logistic


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = []
    for i in range(1200):
        a, b, c, g = rng.gauss(0, 1), rng.gauss(5e5, 1e5), rng.random(), rng.choice("xyz")
        eta = -0.5 + 0.8 * a + (b - 5e5) / 2e5 + (0.9 if g == "y" else 0) + 1.6 * a * (g == "z")
        data.append((a, b, c, float(g == "y"), float(g == "z"), 2 * a, int(rng.random() < 1 / (1 + math.exp(-eta)))))
    return spark.createDataFrame(data, "a double, b double, c double, g_y double, g_z double, twice double, y int")


TERMS = {"a": ["a"], "b": ["b"], "c": ["c"], "g": ["g_y", "g_z"]}


def one_by_one(rows, terms, direction, k, start):
    """The search with a library fit for every candidate."""
    current = list(start)

    def criterion(use):
        return (logistic.fit_logit(rows, "y", terms, use, light=True) if use else
                logistic.null_logit(rows, "y")).criterion(k)

    best, steps = criterion(current), []
    while True:
        options = [("add", t, current + [t]) for t in terms if t not in current] if direction != "backward" else []
        options += [("drop", t, [x for x in current if x != t]) for t in current] if direction != "forward" else []
        found = min(((criterion(use), t, action, use) for action, t, use in options), default=None)
        if found is None or found[0] >= best:
            return steps
        best, current = found[0], found[3]
        steps.append((found[2], found[1], found[0]))


@pytest.mark.parametrize("direction,k", [("forward", None), ("backward", None), ("both", 2.0)])
def test_same_steps_as_single_fits(spark, rows, direction, k):
    fit, steps = logistic.stepwise(rows, "y", TERMS, direction, k)
    start = list(TERMS) if direction == "backward" else []
    want = one_by_one(rows, TERMS, direction, math.log(1200) if k is None else k, start)
    assert [(a, t) for _, a, t, _ in steps[1:]] == [(a, t) for a, t, _ in want]
    assert [c for *_, c in steps[1:]] == pytest.approx([c for *_, c in want], rel=1e-7)
    assert set(fit.terms) == {"a", "b", "g"} if k is None else {"a", "b", "g"} <= set(fit.terms)


def test_jobs_do_not_grow_with_the_terms(spark, rows):
    tracker = spark.sparkContext.statusTracker()
    design = logistic._design(rows, "y", TERMS)
    counts = []
    for i, models in enumerate(([["a"]], [["a"], ["b"], ["c"], ["g"], ["a", "b"], ["a", "g"], ["b", "c"]])):
        spark.sparkContext.setJobGroup(f"step-{i}", "fits")
        fits = logistic._fit_candidates(design, models, np.zeros(6), max_rounds=3)
        counts.append(len(tracker.getJobIdsForGroup(f"step-{i}")))
        assert len(fits) == len(models)
    spark.sparkContext.setJobGroup("", "")
    assert counts[1] <= counts[0]


def test_collinear_columns_do_not_count_as_parameters(spark, rows):
    design = logistic._design(rows, "y", {**TERMS, "twice": ["twice"]})
    plain, doubled = logistic._fit_candidates(design, [["a", "b"], ["a", "b", "twice"]], np.zeros(7))
    assert (plain.rank, doubled.rank) == (3, 3) and plain.deviance == pytest.approx(doubled.deviance, rel=1e-9)


def test_interactions_enter_and_leave_in_order(spark, rows):
    from quarry.operators.transforms import products

    pairs, parts = logistic.interaction_terms(TERMS)
    assert pairs["a:g"] == [("a", "g_y"), ("a", "g_z")] and len(pairs) == 6
    wide = products(rows, [p for term in pairs.values() for p in term])
    terms = TERMS | {t: [f"{a}_x_{b}" for a, b in term] for t, term in pairs.items()}
    left, steps = logistic.stepwise(wide, "y", terms, "backward", parts=parts, final=False)
    assert "a:g" in left and {"a", "g"} <= set(left) and "b:c" not in left
    dropped = [t for _, action, t, _ in steps[1:]]
    for t, needs in parts.items():
        for need in needs:
            if need in dropped:
                assert t in dropped and dropped.index(t) < dropped.index(need)
    full = logistic.fit_logit(wide, "y", terms, list(terms))
    assert steps[0][3] == pytest.approx(full.criterion(math.log(1200)), rel=1e-6)
