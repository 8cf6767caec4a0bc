"""Queries for models and scoring: logistic (G1-G10), trees (D1-D10), forests (R1-R5, M5),
networks (N1-N4), scoring pipelines with save/load (X1-X6, S4, S5)."""

from __future__ import annotations

import functools
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.operators import bagging, evaluate, logistic, network, sampling, tree
from quarry.operators.prep import FittedPrep
from quarry.operators.scoring import ScoringPipeline
from quarry.operators.transforms import FLAG_SUFFIX, products
from quarry.plans.common import mo, with_mo
from quarry.plans.fixtures import mining_docs, split_sql
from quarry.session import cut_lineage, ensure_checkpoint_dir, scratch_table
from quarry.sources.bundle import load_bundle, save_bundle

D = 6
SEED = 42
TARGET = "target_s"
NUMERIC = ["totalprice", "bal", "n_lines", "sum_qty", "avg_price"]
NOMINAL = ["segment", "status"]
FLAG_CANDIDATES = ["bal", "n_lines"]      # sum_qty/avg_price are NULL on exactly the n_lines rows

_FRAMES: dict = {}


def _frame(spark, sf_dir):
    """(prep, train, valid, all) prepared once per session and table folder, with the columns that models read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FRAMES:
        rows = mo(spark, sf_dir).select("id", TARGET, *NUMERIC, *NOMINAL)
        split = scratch_table(sampling.stratified_split(rows, TARGET, "id", (0.5,), ("train", "valid"), SEED), "split")
        train_rows = F.col("split") == "train"
        prep = FittedPrep.fit(split, NUMERIC, NOMINAL, where=train_rows, flag_candidates=FLAG_CANDIDATES)
        # Dozens of search jobs read this frame, each a few of its columns. Imputed inputs, flags and indicators
        # are a narrow projection of the written split, so they are not written a second time.
        allp = prep.transform(split)
        _FRAMES[key] = (prep, allp.filter(train_rows), allp.filter(~train_rows), allp)
    return _FRAMES[key]


def _rows(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------- logistic regression
def null_logit(spark, sf_dir):
    _, train, _, _ = _frame(spark, sf_dir)
    f = logistic.null_logit(train, TARGET)
    return spark.range(1).select(F.round(F.lit(f.intercept), D).alias("intercept"),
                                 F.round(F.lit(f.deviance), 4).alias("deviance"),
                                 F.round(F.lit(f.aic), 4).alias("aic"), F.lit(f.n).cast("long").alias("n"))


def _full_fit(spark, sf_dir):
    prep, train, _, _ = _frame(spark, sf_dir)
    return logistic.fit_logit(train, TARGET, prep.terms(), list(prep.terms()))


_COEF_SCHEMA = "term string, coef double, std_error double, z double, p_value double, odds_ratio double, abs_z double"


def logit_fit(spark, sf_dir):
    return _rows(spark, logistic.coefficient_table(_full_fit(spark, sf_dir)), _COEF_SCHEMA)


def odds_ratio(spark, sf_dir):
    return logit_fit(spark, sf_dir).select("term", "odds_ratio")


def logit_importance(spark, sf_dir):
    return logit_fit(spark, sf_dir).select("term", "abs_z").orderBy(F.desc("abs_z"), "term")


_STEP_SCHEMA = "step int, action string, term string, criterion double"


def _step(spark, sf_dir, direction, k=None):
    prep, train, _, _ = _frame(spark, sf_dir)
    _, steps = logistic.stepwise(train, TARGET, prep.terms(), direction, k, final=False)
    return _rows(spark, steps, _STEP_SCHEMA)


def logit_step_forward(spark, sf_dir):
    return _step(spark, sf_dir, "forward")            # BIC


def logit_step_backward(spark, sf_dir):
    return _step(spark, sf_dir, "backward")           # BIC


def logit_step_both(spark, sf_dir):
    return _step(spark, sf_dir, "both", 2.0)          # AIC


def logit_poly(spark, sf_dir):
    """All pairs of the backward-selected terms (nominal ones included), then backward again (BIC); a main
    term goes only after the interactions that hold it."""
    prep, train, _, _ = _frame(spark, sf_dir)
    chosen, _ = logistic.stepwise(train, TARGET, prep.terms(), "backward", final=False)
    main = {t: prep.terms()[t] for t in chosen}
    pairs, parts = logistic.interaction_terms(main)
    columns = [pair for term in pairs.values() for pair in term]
    wide = products(train.select(TARGET, *[c for t in main.values() for c in t]), columns)
    terms = main | {t: [f"{a}_x_{b}" for a, b in term] for t, term in pairs.items()}
    _, steps = logistic.stepwise(wide, TARGET, terms, "backward", parts=parts, final=False)
    return _rows(spark, steps, _STEP_SCHEMA)


def logit_validate(spark, sf_dir):
    """Selected model (stepwise AIC) scored on validation rows: AUC, top-left cutoff, F1."""
    prep, train, valid, _ = _frame(spark, sf_dir)
    fit, _ = logistic.stepwise(train, TARGET, prep.terms(), "both", 2.0)
    scored = valid.select(F.col(TARGET).alias("actual"), F.round(fit.probability(), D).alias("prob"))
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    cut = evaluate.best_cutoff_midpoint(scored)
    cm = evaluate.confusion_counts(scored.withColumn("pred_class", fc.cutoff_class("prob", cut)))
    a = evaluate.auc(scored).first()["auc"]
    return evaluate.with_rates(cm, D).select(F.lit(cut).alias("cutoff"), F.lit(round(a, D)).alias("auc"),
                                             "f1", "misclass", F.lit(",".join(fit.terms)).alias("terms"))


# ---------------------------------------------------------------- trees
def _tree_inputs(prep) -> tuple[list[str], list[str]]:
    """Inputs of tree models: numbers, missing flags, and nominal inputs as they are (no indicators)."""
    return [*prep.numeric, *(c + FLAG_SUFFIX for c in prep.flags)], list(prep.nominal)


def _grown(spark, sf_dir, weighted=False):
    """Tree grown to cp 0 (node size 20 and 7, depth 30), with its path evaluated on the validation rows."""
    prep, train, valid, _ = _frame(spark, sf_dir)
    weights = (1.0, 1.0)
    if weighted:  # inverse priors, as the loss matrix has them
        rows = sampling.inverse_prior_weights(train, TARGET).groupBy(TARGET).agg(F.first("weight").alias("w")).collect()
        weights = tuple(float({r[TARGET]: r["w"] for r in rows}.get(c, 1.0)) for c in (0, 1))
    numeric, nominal = _tree_inputs(prep)
    model, nodes = tree.grow_cart(train, TARGET, "id", numeric, nominal, class_weights=weights, seed=SEED)
    path = tree.pruning_path(nodes)
    counts = tree.cart_leaf_counts(model, valid, TARGET)
    return prep, model, nodes, path, tree.evaluate_path(nodes, path, counts)


_PATH_SCHEMA = ("idx int, cp double, nsplit int, n_leaves int, rel_error double, valid_misclass double, "
                "valid_f1 double, chosen boolean")


def _path_rows(evals, chosen):
    return [(e["index"], e["cp"], e["nsplit"], e["n_leaves"], e["rel_error"], e["valid_misclass"], e["valid_f1"],
             e["index"] == chosen["index"]) for e in evals]


def tree_fit(spark, sf_dir):
    """Tree at the default complexity 0.01: its rule table."""
    _, model, nodes, path, _ = _grown(spark, sf_dir)
    sub = tree.at_cp(path, 0.01)
    return _rows(spark, tree.cart_rules(model, nodes, sub),
                 "node int, rule string, n double, p_event double, pred_class int")


def tree_cptable(spark, sf_dir):
    """Complexity table of the grown tree with 10-fold cross-validated error."""
    prep, train, _, _ = _frame(spark, sf_dir)
    numeric, nominal = _tree_inputs(prep)
    grow = functools.partial(tree.grow_cart, key="id", numeric=numeric, nominal=nominal)
    model, nodes = grow(train, TARGET)
    path = tree.pruning_path(nodes)
    rows = tree.cross_validated_path(train, TARGET, path, nodes, key="id", folds=10, seed=SEED, grow_fn=grow,
                                     count_fn=tree.cart_leaf_counts)
    return _rows(spark, [(r["cp"], r["nsplit"], r["rel_error"], r["xerror"], r["xstd"]) for r in rows],
                 "cp double, nsplit int, rel_error double, xerror double, xstd double")


def tree_prune_misc(spark, sf_dir):
    _, _, _, _, evals = _grown(spark, sf_dir)
    return _rows(spark, _path_rows(evals, tree.choose(evals, "valid_misclass")), _PATH_SCHEMA)


def tree_prune_f1(spark, sf_dir):
    _, _, _, _, evals = _grown(spark, sf_dir)
    return _rows(spark, _path_rows(evals, tree.choose(evals, "valid_f1")), _PATH_SCHEMA)


def tree_cost(spark, sf_dir):
    """Cost-sensitive tree: inverse-prior weights, subtree chosen by validation F1."""
    _, _, _, _, evals = _grown(spark, sf_dir, weighted=True)
    return _rows(spark, _path_rows(evals, tree.choose(evals, "valid_f1")), _PATH_SCHEMA)


def tree_rules(spark, sf_dir):
    _, model, nodes, path, evals = _grown(spark, sf_dir)
    best = tree.choose(evals, "valid_misclass")
    return _rows(spark, tree.cart_rules(model, nodes, path[best["index"]]),
                 "node int, rule string, n double, p_event double, pred_class int")


def tree_importance(spark, sf_dir):
    _, model, _, _, _ = _grown(spark, sf_dir)
    return _rows(spark, model.importance(), "feature string, importance double")


def tree_ordinal(spark, sf_dir):
    """One input, as a nominal (categorical split) and as an ordinal rank (threshold split)."""
    split = sampling.stratified_split(mo(spark, sf_dir), TARGET, "id", (0.5,), ("train", "valid"), SEED)
    d = split.withColumn("status_rank", fc.ordinal_rank("status", ["F", "P", "O"]).cast("double"))
    d = d.persist(StorageLevel.MEMORY_AND_DISK)
    tr, va = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "valid")
    out = []
    for variant, numeric, nominal in (("nominal", [], ["status"]), ("ordinal", ["status_rank"], [])):
        model, nodes = tree.grow_cart(tr, TARGET, "id", numeric, nominal, seed=SEED)
        path = tree.pruning_path(nodes)
        best = tree.choose(tree.evaluate_path(nodes, path, tree.cart_leaf_counts(model, va, TARGET)))
        out.append((variant, len(nodes), best["n_leaves"], best["valid_misclass"]))
    return _rows(spark, out, "variant string, n_nodes int, n_leaves int, valid_misclass double")


def surrogate_tree(spark, sf_dir):
    """Explain a forest by a tree fitted to the forest's own predictions; fidelity per subtree."""
    prep, _, _, allp = _frame(spark, sf_dir)
    numeric, nominal = _tree_inputs(prep)
    rf = _forest(spark, sf_dir)
    pred = rf.transform(allp.select("id", *numeric, *nominal)).withColumn(
        "rf_pred", (F.col("pred_prob") > 0.5).cast("int"))
    pred = cut_lineage(pred)
    resplit = sampling.stratified_split(pred, "rf_pred", "id", (0.5,), ("train", "valid"), SEED + 1)
    resplit = resplit.persist(StorageLevel.MEMORY_AND_DISK)
    tr, va = resplit.filter(F.col("split") == "train"), resplit.filter(F.col("split") == "valid")
    model, nodes = tree.grow_cart(tr, "rf_pred", "id", numeric, nominal, seed=SEED)
    path = tree.pruning_path(nodes)
    evals = tree.evaluate_path(nodes, path, tree.cart_leaf_counts(model, va, "rf_pred"))
    rows = [(e["index"], e["cp"], e["n_leaves"], 1.0 - e["valid_misclass"]) for e in evals]
    return _rows(spark, rows, "idx int, cp double, n_leaves int, fidelity double")


# ---------------------------------------------------------------- forests
_FORESTS: dict = {}    # paths and sizes of fitted forests; the trees are in the shared folder


def _forest(spark, sf_dir, n_trees=500):
    """Forest of unpruned trees on bootstrap samples of all training rows, fitted once per session and table."""
    key = (spark.sparkContext.applicationId, sf_dir, n_trees)
    if key not in _FORESTS:
        prep, train, _, _ = _frame(spark, sf_dir)
        numeric, nominal = _tree_inputs(prep)
        _FORESTS[key] = bagging.fit(train, TARGET, "id", numeric, nominal, n_trees, mtry=3, seed=SEED)
    return _FORESTS[key]


def _minority(train, target) -> tuple[float, float]:
    """Per-tree sample sizes: the size of the smaller class, of either class."""
    n = train.groupBy(target).count().agg(F.min("count")).first()[0] or 0
    return float(n), float(n)


def forest_fit(spark, sf_dir):
    _, _, valid, _ = _frame(spark, sf_dir)
    rf = _forest(spark, sf_dir)
    scored = rf.transform(valid.select(F.col(TARGET).alias("actual"), *rf.inputs.names)).select(
        "actual", (F.col("pred_prob") > 0.5).cast("int").alias("pred_class"))
    return evaluate.with_rates(evaluate.confusion_counts(scored), D)


def forest_by_ntrees(spark, sf_dir):
    """Out-of-bag and validation error of the first k of 1,000 trees (R2)."""
    _, train, valid, _ = _frame(spark, sf_dir)
    rf, ks = _forest(spark, sf_dir, 1000), [1, 5, 10, 20, 50, 100, 200, 500, 1000]
    oob = bagging.oob_error(rf, train, TARGET, "id", ks).drop("rows")
    valid_err = bagging.valid_error(rf, valid.select(TARGET, *rf.inputs.names), TARGET, ks).drop("rows")
    return oob.join(valid_err, "n_trees")


def forest_mtry(spark, sf_dir):
    """Validation F1 of 201 trees on class-balanced samples for 2 to 5 inputs tried a split."""
    prep, train, valid, _ = _frame(spark, sf_dir)
    numeric, nominal = _tree_inputs(prep)
    rows = bagging.tune_mtry(train, valid, TARGET, "id", numeric, nominal, range(2, 6), 201, seed=SEED,
                             sample_sizes=_minority(train, TARGET))
    best = min(rows, key=lambda r: (-r[1], r[0]))[0]
    return _rows(spark, [(m, f, m == best) for m, f in rows], "mtry int, valid_f1 double, chosen boolean")


def forest_importance(spark, sf_dir):
    rf = _forest(spark, sf_dir)
    return bagging.gini_importance(rf, spark).orderBy(F.desc("importance"), "feature")


def forest_permutation_importance(spark, sf_dir):
    """Mean loss of out-of-bag accuracy when an input's values are exchanged between rows."""
    _, train, _, _ = _frame(spark, sf_dir)
    rf = _forest(spark, sf_dir)
    return bagging.oob_permutation_importance(rf, train, TARGET, "id", seed=SEED).orderBy(
        F.desc("accuracy_drop"), "feature")


def forest_balanced(spark, sf_dir):
    """Imbalanced target (toxic documents): 500 trees on plain samples, with inverse-prior weights, and on
    samples of the minority's size from either class (M5)."""
    docs = mining_docs(spark, sf_dir)
    split = sampling.stratified_split(docs, "toxic", "id", (0.5,), ("train", "valid"), SEED)
    prep = FittedPrep.fit(split, ["n_chars"], ["lang", "source"], where=F.col("split") == "train")
    d = prep.transform(split).persist(StorageLevel.MEMORY_AND_DISK)
    tr, va = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "valid")
    have = {r["toxic"]: r["count"] for r in tr.groupBy("toxic").count().collect()}
    total = sum(have.values())
    priors = tuple(total / have[c] if have.get(c) else 1.0 for c in (0, 1))
    out = []
    for variant, extra in (("plain", {}), ("weighted", {"class_weights": priors}),
                           ("balanced_samples", {"sample_sizes": _minority(tr, "toxic")})):
        rf = bagging.fit(tr, "toxic", "id", ["n_chars"], ["lang", "source"], 500, seed=SEED, **extra)
        scored = rf.transform(va.select(F.col("toxic").alias("actual"), *rf.inputs.names)).select(
            "actual", fc.cutoff_class("pred_prob", 0.5, strict=True).alias("pred_class"))
        row = evaluate.with_rates(evaluate.confusion_counts(scored), D).first()
        out.append((variant, row["tp"], row["fp"], row["fn"], row["tn"], row["f1"]))
    return _rows(spark, out, "variant string, tp long, fp long, fn long, tn long, f1 double")


# ---------------------------------------------------------------- networks
FORCED_TERM = "status"
UNITS = {"4": [4], "4-4": [4, 4], "6-6": [6, 6]}


def _network_inputs(prep, train):
    """Input columns of the backward-selected terms and of the forced one."""
    chosen, _ = logistic.stepwise(train, TARGET, prep.terms(), "backward", final=False)
    return [c for t, cols in prep.terms().items() if t in chosen or t == FORCED_TERM for c in cols]


def mlp_fit_best(spark, sf_dir):
    """6-6 tanh units, at most 40 epochs, patience of 5 on the validation accuracy, best epoch saved and
    reloaded."""
    prep, train, valid, _ = _frame(spark, sf_dir)
    _, history, best = network.fit_network(
        train, valid, TARGET, "id", _network_inputs(prep, train), [6, 6], monitor="accuracy", seed=SEED,
        checkpoint_path=_bundle_path(spark, "network-best"))
    return _rows(spark, [(e, loss, acc, e == best) for e, loss, acc in history],
                 "epoch int, val_loss double, val_accuracy double, best boolean")


def mlp_by_units(spark, sf_dir):
    """Networks of several shapes on all inputs, early stopping on the validation loss: epochs taken, the
    best one, and its loss and accuracy on training and validation rows."""
    prep, train, valid, _ = _frame(spark, sf_dir)

    def one(name):
        net, history, best = network.fit_network(train, valid, TARGET, "id", prep.feature_columns(), UNITS[name], seed=SEED)
        return (name, len(net.flat), len(history), best, *network.evaluate(net, train, TARGET),
                *network.evaluate(net, valid, TARGET))

    # Steps of one network wait for each other, networks do not.
    with ThreadPoolExecutor(max_workers=len(UNITS)) as pool:
        out = list(pool.map(one, UNITS))
    return _rows(spark, out, "units string, weights int, epochs int, best_epoch int, train_loss double, "
                             "train_accuracy double, val_loss double, val_accuracy double")


# ---------------------------------------------------------------- scoring pipelines
def _bundle_path(spark, name):
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/bundle-{name}-{uuid.uuid4().hex}"


def _score_roundtrip(spark, sf_dir, pipe: ScoringPipeline, name: str):
    """Save the bundle, load it back and score every row of the raw table."""
    path = _bundle_path(spark, name)
    save_bundle(spark, pipe, path)
    loaded = load_bundle(spark, path)
    return loaded.transform(mo(spark, sf_dir))


def _logit_pipeline(spark, sf_dir):
    prep, train, valid, _ = _frame(spark, sf_dir)
    fit, _ = logistic.stepwise(train, TARGET, prep.terms(), "backward")
    scored = valid.select(F.col(TARGET).alias("actual"), F.round(fit.probability(), D).alias("prob"))
    cut = evaluate.best_cutoff_midpoint(scored)
    return ScoringPipeline(prep, fit.columns, "logit", cutoff=cut, strict=False, intercept=fit.intercept,
                           coefs=fit.coef_map())


def score_logit(spark, sf_dir):
    return _score_roundtrip(spark, sf_dir, _logit_pipeline(spark, sf_dir), "logit")


def score_forest(spark, sf_dir):
    prep, _, _, _ = _frame(spark, sf_dir)
    pipe = ScoringPipeline(prep, prep.feature_columns(), "forest", cutoff=0.5, strict=True, model=_forest(spark, sf_dir))
    return _score_roundtrip(spark, sf_dir, pipe, "forest")


def score_mlp(spark, sf_dir):
    """Network of 4 tanh units, 40 epochs, best validation loss kept; cutoff closest to the top left."""
    prep, train, valid, _ = _frame(spark, sf_dir)
    net, _, _ = network.fit_network(train, valid, TARGET, "id", prep.feature_columns(), [4], patience=None, seed=SEED)
    scored = net.transform(valid.select(F.col(TARGET).alias("actual"), *prep.feature_columns()), "prob")
    cut = evaluate.best_cutoff_midpoint(scored.select("actual", F.round("prob", D).alias("prob")))
    pipe = ScoringPipeline(prep, prep.feature_columns(), "network", cutoff=cut, strict=False, model=net)
    return _score_roundtrip(spark, sf_dir, pipe, "mlp")


# Relabel map of the balanced-data pipeline (fixed values).
SEGMENT_GROUPS = {"AUTOMOBILE": "AUTO", "BUILDING": "HOME", "HOUSEHOLD": "HOME", "MACHINERY": "INDUSTRY"}


def score_balanced_logit(spark, sf_dir):
    """Balanced-data pipeline (X1): down-sampled training rows; log of skewed inputs, level relabel,
    train means, missing flags, full logistic model, class = prob > 0.5 (strict)."""
    d = sampling.stratified_split(mo(spark, sf_dir), "target_b", "id", (0.5,), ("train", "valid"), SEED)
    train_rows = sampling.downsample(d.filter(F.col("split") == "train"), "target_b", "id", seed=7)
    train_rows = train_rows.persist(StorageLevel.MEMORY_AND_DISK)
    prep = FittedPrep.fit(train_rows, NUMERIC, NOMINAL, log_cols=["sum_qty", "avg_price"],
                          level_maps={"segment": SEGMENT_GROUPS}, flag_candidates=FLAG_CANDIDATES)
    x = prep.transform(train_rows)
    fit = logistic.fit_logit(x, "target_b", prep.terms(), list(prep.terms()))
    pipe = ScoringPipeline(prep, fit.columns, "logit", cutoff=0.5, strict=True, intercept=fit.intercept,
                           coefs=fit.coef_map())
    return _score_roundtrip(spark, sf_dir, pipe, "balanced-logit")


# Cleaning rules of the full-cleaning pipeline (fixed values).
STATUS_ORDER = ["F", "P", "O"]
PRIORITY_GROUPS = {"1-URGENT": "HIGH", "2-HIGH": "HIGH", "3-MEDIUM": "MEDIUM"}


def _clean(df):
    """Derived, cleaned inputs next to the untouched raw columns (a narrow projection)."""
    return df.select(
        "*",
        fc.ordinal_rank("status", STATUS_ORDER).cast("double").alias("status_rank"),
        fc.level_map("segment", SEGMENT_GROUPS).alias("segment_grp"),
        fc.sentinel_null(F.col("n_lines").cast("double"), 1.0).alias("multi_lines"),
        fc.below_null("bal", 1).alias("bal_pos"),
        fc.weighted_score([F.col("avg_price") / 1000.0, F.col("sum_qty")], [2 / 3, 1 / 3]).alias("size_score"))


def score_forest_clean(spark, sf_dir):
    """Full-cleaning forest pipeline (the shape of X5): ordinal rank, relabel, sentinel and range
    NULLs, weighted score, train means/modes, flags, forest; scores every raw row."""
    d = sampling.stratified_split(_clean(mo(spark, sf_dir)), TARGET, "id", (0.5,), ("train", "valid"), SEED)
    d = d.persist(StorageLevel.MEMORY_AND_DISK)
    num = ["totalprice", "status_rank", "multi_lines", "bal_pos", "size_score"]
    prep = FittedPrep.fit(d, num, ["segment_grp"], where=F.col("split") == "train",
                          flag_candidates=["multi_lines", "bal_pos"])
    train = prep.transform(d.filter(F.col("split") == "train"))
    numeric, nominal = _tree_inputs(prep)
    rf = bagging.fit(train, TARGET, "id", numeric, nominal, 500, mtry=3, sample_sizes=_minority(train, TARGET), seed=SEED)
    pipe = ScoringPipeline(prep, prep.feature_columns(), "forest", cutoff=0.5, strict=True, model=rf)
    path = _bundle_path(spark, "forest-clean")
    save_bundle(spark, pipe, path)
    scored = load_bundle(spark, path).transform(_clean(mo(spark, sf_dir)))
    return scored.drop("status_rank", "segment_grp", "multi_lines", "bal_pos", "size_score")


def score_report(spark, sf_dir):
    """Class counts and shares of a scored table."""
    s = score_logit(spark, sf_dir)
    c = s.groupBy("pred_class").agg(F.count(F.lit(1)).alias("n"))
    return c.select("pred_class", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), D).alias("share"))


QUERIES = {
    "null_logit": null_logit,
    "logit_fit": logit_fit,
    "odds_ratio": odds_ratio,
    "logit_importance": logit_importance,
    "logit_step_forward": logit_step_forward,
    "logit_step_backward": logit_step_backward,
    "logit_step_both": logit_step_both,
    "logit_poly": logit_poly,
    "logit_validate": logit_validate,
    "tree_fit": tree_fit,
    "tree_cptable": tree_cptable,
    "tree_prune_misc": tree_prune_misc,
    "tree_prune_f1": tree_prune_f1,
    "tree_cost": tree_cost,
    "tree_rules": tree_rules,
    "tree_importance": tree_importance,
    "tree_ordinal": tree_ordinal,
    "surrogate_tree": surrogate_tree,
    "forest_fit": forest_fit,
    "forest_by_ntrees": forest_by_ntrees,
    "forest_mtry": forest_mtry,
    "forest_importance": forest_importance,
    "forest_permutation_importance": forest_permutation_importance,
    "forest_balanced": forest_balanced,
    "mlp_fit_best": mlp_fit_best,
    "mlp_by_units": mlp_by_units,
    "score_logit": score_logit,
    "score_forest": score_forest,
    "score_mlp": score_mlp,
    "score_report": score_report,
    "score_balanced_logit": score_balanced_logit,
    "score_forest_clean": score_forest_clean,
}

ORACLE = {
    "null_logit": with_mo(split_sql(TARGET, 0.5, SEED) + """,
t AS (SELECT count(*) AS n, CAST(sum(target_s) AS DOUBLE) AS k FROM split WHERE split = 'train')
SELECT round(ln((k / n) / (1 - k / n)), 6) AS intercept,
       round(-2 * (k * ln(k / n) + (n - k) * ln(1 - k / n)), 4) AS deviance,
       round(-2 * (k * ln(k / n) + (n - k) * ln(1 - k / n)) + 2, 4) AS aic, n FROM t"""),
}
