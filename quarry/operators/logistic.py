"""Logistic regression (G1-G10): fits, intercept-only model, stepwise term selection by AIC/BIC.

A single fit with its inference table is Spark's IRLS (one distributed normal-equation aggregate per
iteration). The stepwise search fits all candidate terms of a step together: each round is one job that
sums the normal equations of every candidate, so the number of jobs does not grow with the terms.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.functions.columns import named
from quarry.session import right_size


@dataclass
class LogitFit:
    terms: list[str]
    columns: list[str]
    intercept: float
    coefs: list[float]
    std_errors: list[float]
    z: list[float]
    p_values: list[float]
    deviance: float
    aic: float
    n: int

    def criterion(self, k: float) -> float:
        """-2 logLik + k * parameters (k = 2: AIC, k = log n: BIC)."""
        n_par = len(self.columns) + 1
        return self.aic - 2 * n_par + k * n_par

    def coef_map(self) -> dict[str, float]:
        return dict(zip(self.columns, self.coefs))

    def probability(self) -> "F.Column":
        return fc.sigmoid(fc.linear_predictor(self.coef_map(), self.intercept))


def fit_logit(train: DataFrame, target: str, terms: dict[str, list[str]], use: Sequence[str],
              weight_col: str | None = None, max_iter: int = 50, light: bool = False) -> LogitFit:
    """IRLS fit of the given terms. `light` skips the inference tables (search candidates only
    need the criterion), saving one pass over the data."""
    cols = [c for t in use for c in terms[t]]
    if not cols:
        return null_logit(train, target)
    data = VectorAssembler(inputCols=cols, outputCol="__x").transform(train)
    glm = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="__x", labelCol=target,
                                      maxIter=max_iter)
    if weight_col:
        glm = glm.setWeightCol(weight_col)
    # Every iteration, and every statistic, is a pass over these rows.
    columns = [target, "__x", *([weight_col] if weight_col else [])]
    data = data.select(*map(named, columns)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fitted(glm.fit(data), use, cols, light)
    finally:
        data.unpersist()


def _fitted(m, use: Sequence[str], cols: list[str], light: bool) -> LogitFit:
    s, k = m.summary, len(cols)
    aic = float(s.aic)
    if light:
        return LogitFit(list(use), cols, float(m.intercept), [float(x) for x in m.coefficients],
                        [], [], [], float("nan"), aic, 0)
    se, z, p = list(s.coefficientStandardErrors), list(s.tValues), list(s.pValues)
    # The summary lists the intercept last.
    return LogitFit(list(use), cols, float(m.intercept), [float(x) for x in m.coefficients],
                    se[:k], z[:k], p[:k], float(s.deviance), aic, int(s.numInstances))


def null_logit(train: DataFrame, target: str) -> LogitFit:
    """Intercept-only fit in closed form: logit of the event rate; deviance from the class counts."""
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("double")).alias("k")).first()
    n, k = int(row["n"]), float(row["k"])
    if not n:
        raise ValueError("no rows to fit")
    p = k / n
    dev = -2.0 * ((k * math.log(p) if k > 0 else 0.0) + ((n - k) * math.log(1 - p) if k < n else 0.0))
    odds = math.inf if k == n else p / (1 - p)
    return LogitFit([], [], math.log(odds) if odds else -math.inf, [], [], [], [], dev, dev + 2.0, n)


@dataclass
class _Design:
    """Standardized columns of all terms, packed in blocks of rows, with an intercept column in front."""

    blocks: DataFrame                  # y and x as packed doubles
    places: dict[str, list[int]]       # term -> columns

    def columns(self, terms: Sequence[str]) -> np.ndarray:
        return np.array([0] + [i for t in terms for i in self.places[t]])


@dataclass
class _Candidate:
    beta: np.ndarray                   # all columns of the design, zero where a term is not in
    deviance: float
    rank: int

    def criterion(self, k: float) -> float:
        return self.deviance + k * self.rank


def _design(train: DataFrame, target: str, terms: dict[str, list[str]]) -> _Design:
    """Rows with a NULL input are left out. Columns are centred and scaled, which changes no model that has
    an intercept, only the conditioning of its equations."""
    columns = list(dict.fromkeys(c for cols in terms.values() for c in cols))
    rows = train.select(named(target).cast("double").alias("y"),
                        *[named(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]).dropna()
    row = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(columns))],
                   *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(len(columns))]).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(len(columns))])
    sd = np.array([row[f"s{i}"] or 1.0 for i in range(len(columns))])

    def pack(batches):
        for batch in batches:
            x = np.ones((batch.num_rows, 1 + len(columns)))
            for i in range(len(columns)):
                x[:, 1 + i] = (batch.column(1 + i).to_numpy() - mean[i]) / sd[i]
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).to_numpy().tobytes()], pa.binary()),
                                              pa.array([x.tobytes()], pa.binary())], ["y", "x"])

    blocks = right_size(rows, row["n"]).mapInArrow(pack, "y binary, x binary").persist(StorageLevel.MEMORY_AND_DISK)
    at = {c: 1 + i for i, c in enumerate(columns)}
    return _Design(blocks, {t: [at[c] for c in cols] for t, cols in terms.items()})


def _fit_candidates(design: _Design, models: Sequence[Sequence[str]], start: np.ndarray,
                    tolerance: float = 1e-8, max_rounds: int = 25) -> list[_Candidate]:
    """Fit all models by iteratively reweighted least squares, one job a round for all of them.

    A task adds up, for every model that has not converged, X'WX, X'Wz and the deviance at its present
    coefficients; the sums of a model meet in one row, and the driver solves the small systems. Collinear columns
    lower a model's rank, as aliased coefficients do, and not its fit.
    """
    picked = [design.columns(m) for m in models]
    betas = [start[c].copy() for c in picked]
    deviance, ranks = [math.inf] * len(models), [len(c) for c in picked]
    running = set(range(len(models)))

    def add_up(now: dict[int, tuple[np.ndarray, np.ndarray]]):
        def task(batches):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for y, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    y = np.frombuffer(y)
                    x = np.frombuffer(x).reshape(len(y), -1)
                    for model, (cols, beta) in now.items():
                        part = x[:, cols]
                        eta = np.clip(part @ beta, -700.0, 700.0)
                        mu = np.clip(1.0 / (1.0 + np.exp(-eta)), 1e-15, 1.0 - 1e-15)
                        w = mu * (1.0 - mu)
                        weighted = part * w[:, None]
                        loss = -2.0 * float(np.sum(np.where(y > 0, np.log(mu), np.log1p(-mu))))
                        found = np.concatenate([(weighted.T @ part).ravel(), weighted.T @ eta + part.T @ (y - mu), [loss]])
                        sums[model] = sums[model] + found if model in sums else found
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                                  pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                                 ["model", "sums"])
        return task

    def together(key, table):
        total = sum(np.frombuffer(v) for v in table.column("sums").to_pylist())
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["model", "sums"])

    schema = "model int, sums binary"
    for _ in range(max_rounds):
        now = {m: (picked[m], betas[m]) for m in running}
        rows = design.blocks.mapInArrow(add_up(now), schema).groupBy("model").applyInArrow(together, schema).collect()
        for r in rows:
            m, k, values = r["model"], len(picked[r["model"]]), np.frombuffer(r["sums"])
            loss = float(values[-1])
            done = abs(deviance[m] - loss) < tolerance * (abs(loss) + 0.1)
            deviance[m] = loss
            if done:
                running.discard(m)
                continue
            gram, rhs = values[:k * k].reshape(k, k), values[k * k:-1]
            scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))
            solved, _, ranks[m], _ = np.linalg.lstsq(gram / np.outer(scale, scale), rhs / scale, rcond=1e-10)
            betas[m] = solved / scale
        if not running:
            break
    out = []
    for m in range(len(models)):
        beta = np.zeros(len(start))
        beta[picked[m]] = betas[m]
        out.append(_Candidate(beta, deviance[m], int(ranks[m])))
    return out


def stepwise(train: DataFrame, target: str, terms: dict[str, list[str]], direction: str = "both",
             k: float | None = None, start: Sequence[str] | None = None, max_steps: int = 100,
             parts: dict[str, Sequence[str]] | None = None, final: bool = True):
    """Greedy term selection minimising -2 logLik + k * parameters.

    direction: "forward" (from the empty model), "backward" (from all terms) or "both" (from
    `start`, default empty, adding or dropping one term per step). `parts` names the lower terms of an interaction:
    it enters after them, and none of them is dropped before it. All candidates of a step are fitted together,
    starting from the present model. Returns (final fit, steps) where steps is a list of
    (step, action, term, criterion); without `final` the fit is the list of terms.
    """
    n = train.count()
    k = math.log(n) if k is None else k
    parts = parts or {}
    design = _design(train, target, terms)
    try:
        if start is None:
            start = list(terms) if direction == "backward" else []
        current = list(start)
        width = 1 + max((i for cols in design.places.values() for i in cols), default=0)
        best, = _fit_candidates(design, [current], np.zeros(width))
        steps = [(0, "start", "", best.criterion(k))]
        for step in range(1, max_steps + 1):
            candidates = []
            if direction in ("forward", "both"):
                candidates += [("add", t, current + [t]) for t in terms
                               if t not in current and set(parts.get(t, ())) <= set(current)]
            if direction in ("backward", "both"):
                needed = {p for t in current for p in parts.get(t, ())}
                candidates += [("drop", t, [x for x in current if x != t]) for t in current if t not in needed]
            if not candidates:
                break
            fits = _fit_candidates(design, [c[2] for c in candidates], best.beta)
            fit, (action, t, use) = min(zip(fits, candidates), key=lambda f: (f[0].criterion(k), f[1][1]))
            if fit.criterion(k) >= best.criterion(k):
                break
            best, current = fit, use
            steps.append((step, action, t, fit.criterion(k)))
    finally:
        design.blocks.unpersist()
    return (fit_logit(train, target, terms, current) if final else current), steps


def interaction_terms(terms: dict[str, list[str]]) -> tuple[dict[str, list[tuple[str, str]]], dict[str, tuple[str, str]]]:
    """All pairs of terms, `a:b`: the pairs of columns that are multiplied, and the two terms that they
    come from. A nominal term's indicators are each multiplied with every column of the other term."""
    names = list(terms)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    return ({f"{a}:{b}": [(x, y) for x in terms[a] for y in terms[b]] for a, b in pairs},
            {f"{a}:{b}": (a, b) for a, b in pairs})


def coefficient_table(fit: LogitFit) -> list[tuple]:
    """(term column, coef, std error, z, p, odds ratio, |z|) rows."""
    return [(c, b, s, z, p, math.exp(b), abs(z))
            for c, b, s, z, p in zip(fit.columns, fit.coefs, fit.std_errors, fit.z, fit.p_values)]
