"""Hand-made frames for edge cases: ties, one class, all-NULL column, unseen level, empty part,
duplicate basket items, null tokens, currency text."""

import collections
import itertools
import math
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.operators import basket, evaluate, explore, impute, transforms
from quarry.sources import csv


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "actual int, prob double")
    assert abs(evaluate.auc(df).first()["auc"] - (1 + 0.5 + 1 + 1) / 4) < 1e-12


def test_confusion_zero_filled_when_one_class_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "actual int, pred_class int")
    row = evaluate.with_rates(evaluate.confusion_counts(df)).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (0, 0, 1, 2)
    assert row["f1"] == 0.0


def test_all_null_column_and_unseen_level(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, None, "a")], "id long, x double, lv string")
    means = impute.fit_means(df, ["x"])
    assert means["x"] is None
    assert impute.apply_fill(df, means).filter(F.col("x").isNull()).count() == 3
    mapped = df.select(fc.level_map("lv", {"a": "A"}).alias("m")).collect()
    assert sorted((r["m"] is None) for r in mapped) == [False, False, True]


def test_mode_ignores_null_and_breaks_ties_by_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert impute.fit_modes(df, ["c"])["c"] == "a"


def test_empty_validation_part(spark):
    df = spark.createDataFrame([(1, 1)], "actual int, pred_class int").filter(F.lit(False))
    cm = evaluate.confusion_counts(df).collect()
    assert cm == [] or tuple(cm[0]) == (0, 0, 0, 0)


def test_duplicate_items_in_basket(spark):
    pairs = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "y")], "b long, i string")
    b = basket.build_baskets(pairs, "b", "i").orderBy("basket").collect()
    assert [r["items"] for r in b] == [["x", "y"], ["y"]]


def test_currency_and_tokens(spark):
    df = spark.createDataFrame([("$1,200.50",), ("junk",), ("?",)], "t string")
    out = df.select(fc.parse_number(fc.null_tokens("t")).alias("v")).collect()
    assert out[0]["v"] == 1200.5 and out[1]["v"] is None and out[2]["v"] is None


def test_csv_tokens_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="quarry-csv-")
    path = os.path.join(d, "in.csv")
    with open(path, "w") as f:
        f.write("a,b,c\n1,x,2.5\n.,NA,\n?,y,3\nNA,,1e3\n")
    df = csv.read_csv(spark, path)
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    rows = df.collect()
    assert [r["a"] for r in rows] == [1, None, None, None]
    assert [r["b"] for r in rows] == ["x", None, "y", None]


def test_relevel_and_daypart(spark):
    levels = ["A", "B", "Under 2000"]
    assert transforms_relevel(levels, "Under 2000") == ["Under 2000", "A", "B"]
    hours = spark.createDataFrame([(h,) for h in range(24)], "h int")
    parts = {r["h"]: r["d"] for r in hours.select("h", fc.daypart("h").alias("d")).collect()}
    assert parts[5] == "M" and parts[12] == "A" and parts[17] == "E" and parts[21] == "N" and parts[4] == "N"


def transforms_relevel(levels, ref):
    return transforms.relevel(levels, ref)


def test_histogram_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,)], "x double")
    h = {r["bin"]: r["n"] for r in explore.histogram(df, ["x"], 5).collect()}
    assert h == {1: 3, 5: 1}          # width 2: [0, 2] holds 0, 1, 2 (right-closed, lowest included)


def test_fit_time_state_applies_by_name(spark):
    """Flags come from the fit-time list (Q6); unseen levels give all-zero dummies; stored means
    and modes apply by column name whatever the column order of the scored table (Q12)."""
    from quarry.operators.prep import FittedPrep
    train = spark.createDataFrame([(1.0, None, "a"), (3.0, 2.0, "b"), (None, 4.0, "a")], "x double, y double, c string")
    prep = FittedPrep.fit(train, ["x", "y"], ["c"])
    assert sorted(prep.flags) == ["x", "y"] and prep.means == {"x": 2.0, "y": 3.0} and prep.modes == {"c": "a"}
    # Scored table: other column order, a NULL-free x, an unseen level and a NULL level.
    score = spark.createDataFrame([("z", 5.0, 7.0), (None, None, 1.0)], "c string, y double, x double")
    out = {r["x"]: r for r in prep.transform(score).collect()}
    assert set(prep.transform(score).columns) >= {"x_NA", "y_NA", "c_b"}
    assert out[7.0]["c_b"] == 0 and out[7.0]["x_NA"] == 0 and out[7.0]["y_NA"] == 0
    assert out[1.0]["y"] == 3.0 and out[1.0]["y_NA"] == 1 and out[1.0]["c"] == "a" and out[1.0]["c_b"] == 0


def test_cutoff_strict_and_inclusive(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (0.51,)], "p double")
    rows = df.select(fc.cutoff_class("p", 0.5, strict=True).alias("s"),
                     fc.cutoff_class("p", 0.5, strict=False).alias("i")).collect()
    assert [(r["s"], r["i"]) for r in rows] == [(0, 1), (0, 0), (1, 1)]


@pytest.mark.parametrize("support, confidence", [(0.02, 0.1), (0.3, 0.5), (0.9, 0.1)])
def test_rules_equal_counts_of_all_subsets(spark, support, confidence):
    rng = random.Random(3)
    baskets = [sorted(rng.sample("abcdefg", rng.randint(1, 4))) + ["x", "y"] * (rng.random() < 0.4) for _ in range(300)]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)], "basket int, items array<string>")
    freq, n = collections.Counter(), len(baskets)
    for b in baskets:
        freq.update(s for k in range(1, len(b) + 1) for s in itertools.combinations(sorted(b), k))
    freq = {s: c for s, c in freq.items() if c >= math.ceil(support * n)}
    want = {}
    for s, c in freq.items():
        for item in s if len(s) > 1 else ():
            rest = tuple(x for x in s if x != item)
            if c / freq[rest] >= confidence:
                want[rest, item] = (c / n, c / freq[rest], c / freq[rest] / (freq[item,] / n))
    got = {(tuple(r.antecedent), *r.consequent): (r.support, r.confidence, r.lift)
           for r in basket.association_rules(df, support, confidence).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    weighted = df.groupBy("items").count().withColumnRenamed("count", "n")
    assert {tuple(r["items"]): r.freq for r in basket.frequent_item_sets(weighted, math.ceil(support * n)).collect()} == freq
    assert basket.association_rules(df.limit(0), support, confidence, include_empty_lhs=True).count() == 0
