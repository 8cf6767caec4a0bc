"""Invariants of the model operators on small hand-made and fixture data."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quarry.operators import cluster, logistic, tree
from quarry.operators.prep import FittedPrep
from quarry.operators.scoring import ScoringPipeline
from quarry.plans.fixtures import mining_orders
from quarry.sources.bundle import load_bundle, save_bundle

from small_tables import SF_SMALL


def _frame(spark):
    d = mining_orders(spark, SF_SMALL)
    prep = FittedPrep.fit(d, ["totalprice", "bal"], ["status"], flag_candidates=["bal"])
    x = VectorAssembler(inputCols=prep.feature_columns(), outputCol="features").transform(prep.transform(d))
    return prep, x.cache()


def test_pruning_path_invariants(spark):
    prep, x = _frame(spark)
    model, nodes = tree.grow(x, "target_s", max_depth=5)
    path = tree.pruning_path(nodes)
    assert path[0].n_leaves == len(tree.leaf_order(nodes))
    assert path[-1].n_leaves == 1
    leaves = [p.n_leaves for p in path]
    errs = [p.rel_error for p in path]
    assert leaves == sorted(leaves, reverse=True)
    assert errs == sorted(errs)          # pruning never lowers the training error
    evals = tree.evaluate_path(nodes, path, tree.leaf_counts(model, x, "target_s"))
    best = tree.choose(evals)
    assert best["n_leaves"] <= path[0].n_leaves


def test_stepwise_never_worse_than_start(spark):
    prep, x = _frame(spark)
    start = logistic.null_logit(x, "target_s")
    fit, steps = logistic.stepwise(x, "target_s", prep.terms(), "forward", k=2.0)
    assert fit.criterion(2.0) <= start.criterion(2.0) + 1e-9
    crit = [s[3] for s in steps]
    assert crit == sorted(crit, reverse=True)


def test_kmeans_best_of_seeds_below_total_ss(spark):
    d = mining_orders(spark, SF_SMALL).select("totalprice", "n_lines").dropna()
    x = cluster.assemble(d, ["totalprice", "n_lines"])
    _, cost, _ = cluster.multistart(x, 3, [1, 2, 3])
    assert cost <= cluster.total_ss(d, ["totalprice", "n_lines"]) + 1e-6


def test_score_after_reload_equals_before(spark, tmp_path):
    prep, x = _frame(spark)
    fit = logistic.fit_logit(x, "target_s", prep.terms(), list(prep.terms()))
    pipe = ScoringPipeline(prep, fit.columns, "logit", cutoff=0.4, intercept=fit.intercept, coefs=fit.coef_map())
    raw = mining_orders(spark, SF_SMALL)
    before = {r["id"]: (r["pred_prob"], r["pred_class"]) for r in pipe.transform(raw).collect()}
    save_bundle(spark, pipe, str(tmp_path / "b"))
    after = {r["id"]: (r["pred_prob"], r["pred_class"]) for r in load_bundle(spark, str(tmp_path / "b")).transform(raw).collect()}
    assert before == after
    assert all(0.0 <= p <= 1.0 for p, _ in before.values())
    assert set(pipe.transform(raw).columns) == set(raw.columns) | {"pred_prob", "pred_class"}


def test_permute_column_is_a_permutation(spark):
    from quarry.operators.forest import permute_column
    df = spark.createDataFrame([(i, float(i * i), i % 3) for i in range(200)], "id long, x double, g int")
    p = permute_column(df, "x", "id", seed=5)
    assert p.count() == 200
    assert sorted(r["x"] for r in p.collect()) == sorted(r["x"] for r in df.collect())
    moved = p.join(df.withColumnRenamed("x", "x0"), ["id", "g"]).filter("x != x0").count()
    assert moved > 150


def test_stream_scoring_equals_batch(spark):
    from quarry.operators import forest
    from quarry.streaming.score_stream import score_stream, table_stream
    prep, x = _frame(spark)
    rf = forest.fit_forest(x, "target_s", n_trees=5, mtry=2, seed=3)
    pipe = ScoringPipeline(prep, prep.feature_columns(), "spark", cutoff=0.5, strict=True, model=rf)
    batch = {(r["id"], round(r["pred_prob"], 12), r["pred_class"])
             for r in pipe.transform(mining_orders(spark, SF_SMALL)).collect()}
    streamed = score_stream(spark, table_stream(spark, SF_SMALL, "orders"),
                            lambda s: pipe.transform(mining_orders(spark, SF_SMALL, orders=s)), "test")
    got = {(r["id"], round(r["pred_prob"], 12), r["pred_class"]) for r in streamed.collect()}
    assert got == batch


def test_confusion_inference_values(spark):
    from quarry.functions import pvalues
    from quarry.operators import evaluate
    rows = [(1, 1)] * 40 + [(0, 0)] * 45 + [(0, 1)] * 5 + [(1, 0)] * 10
    cm = evaluate.confusion_counts(spark.createDataFrame(rows, "actual int, pred_class int"))
    r = evaluate.confusion_inference(cm).first()
    assert r["n"] == 100 and abs(r["accuracy"] - 0.85) < 1e-12
    lo, hi = pvalues.binom_ci(85, 100)
    assert abs(r["acc_ci_low"] - lo) < 1e-12 and abs(r["acc_ci_high"] - hi) < 1e-12
    assert abs(r["mcnemar_stat"] - (abs(5 - 10) - 1) ** 2 / 15) < 1e-12
    assert abs(r["mcnemar_p"] - pvalues.chi2_sf(16 / 15, 1)) < 1e-12
    assert r["nir"] == 0.5 and r["p_acc_gt_nir"] < 1e-10


def test_cross_validated_cp_table(spark):
    prep, x = _frame(spark)
    model, nodes = tree.grow(x, "target_s", max_depth=4)
    path = tree.pruning_path(nodes)
    cv = tree.cross_validated_path(x, "target_s", path, nodes, key="id", folds=5, seed=1, max_depth=4)
    assert len(cv) == len(path)
    assert all(r["xerror"] >= 0 and r["xstd"] >= 0 for r in cv)
    root = [r for r in cv if r["nsplit"] == 0][0]
    assert 0.8 <= root["xerror"] <= 1.2        # the root predicts the majority class in every fold
