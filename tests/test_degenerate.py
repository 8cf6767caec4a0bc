"""NULL classes and keys, string keys, quoted CSV cells, constant columns and single classes."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import evaluate, explore, importance, joins, logistic, ranking, sampling, select, transforms
from quarry.sources import csv


@pytest.fixture
def rows(spark):
    data = [(i, None if i % 10 == 0 else ("a" if i % 3 else "b"), None if i % 7 == 0 else float(i * 37 % 101), f"key-{i:03d}")
            for i in range(100)]
    return spark.createDataFrame(data, "id long, cls string, x double, name string")


@pytest.mark.parametrize("size", [3, 10_000_000])
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("key", ["x", "name", "id"])
def test_ranks_keep_every_row_at_any_bucket_size(rows, size, descending, key):
    got = ranking.with_running_totals(rows, key, {"r": F.lit(1).cast("long")}, tie_cols=["id"], descending=descending,
                                      partition_cols=["cls"], rows_per_bucket=size, group_totals=True).collect()
    assert len(got) == 100
    for cls in ("a", "b", None):
        part = sorted((r for r in got if r.cls == cls), key=lambda r: r.r)
        assert [r.r for r in part] == list(range(1, len(part) + 1))
        assert {r.r_total for r in part} == {len(part)}
        # Spark's order: NULLs first when ascending, last when descending
        order = sorted(part, key=lambda r: (r[key] is not None, r[key] if r[key] is not None else 0, r.id), reverse=descending)
        assert [r.id for r in part] == [r.id for r in order]


def test_row_slices_with_null_and_string_keys(rows):
    assert [r.id for r in select.row_slice(rows, "name", 3, 5).orderBy("id").collect()] == [2, 3, 4]
    assert select.row_slice(rows, "x", 1, 15).filter("x IS NULL").count() == 15
    assert select.row_slice(rows, "x", 1, 15, exclude=True).count() == 85


def test_null_class_in_splits_and_samples(rows):
    split = sampling.stratified_split(rows, "cls", "id", (0.5,))
    assert split.count() == 100 and split.filter("cls IS NULL AND split = 'train'").count() == 5
    sample = {r.cls: r["count"] for r in sampling.downsample(rows, "cls", "id").groupBy("cls").count().collect()}
    small = min(r["count"] for r in rows.filter("cls IS NOT NULL").groupBy("cls").count().collect())
    assert sample == {"a": small, "b": small}
    flagged = sampling.downsample(rows, "cls", "id", out="flag")
    assert flagged.count() == 100 and flagged.filter("cls IS NULL AND flag = 1").count() == 0


def test_null_class_in_summaries(rows):
    out = {r.cls: r for r in explore.numeric_summary(rows, ["x"], ["cls"]).collect()}
    assert out.keys() == {"a", "b", None} and out[None].median is not None
    assert {r.cls for r in explore.trimmed_mean_mad(rows, ["x"], ["cls"]).collect()} == {"a", "b", None}


def test_null_safe_join_keeps_left_rows(spark):
    a = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k int, v int")
    b = spark.createDataFrame([(None, 10), (1, 20)], "k int, w int")
    got = sorted(map(str, joins.join_null_safe(a, b, ["k"], "left").collect()))
    assert got == ["Row(k=1, v=2, w=20)", "Row(k=2, v=3, w=None)", "Row(k=None, v=1, w=10)"]


def test_csv_cells_with_quotes_commas_and_newlines(spark, tmp_path):
    (tmp_path / "in.csv").write_text('"id","note"\n1,"say ""hi"", ok"\n2,"two\nlines"\n3,"a\\b"\n4,?\n')
    df = csv.read_csv(spark, str(tmp_path / "in.csv"))
    want = [(1, 'say "hi", ok'), (2, "two\nlines"), (3, "a\\b"), (4, None)]
    assert [tuple(r) for r in df.orderBy("id").collect()] == want
    csv.write_csv(df.filter("note IS NOT NULL"), str(tmp_path / "out"))
    assert [tuple(r) for r in csv.read_csv(spark, str(tmp_path / "out")).orderBy("id").collect()] == want[:3]


def test_constant_columns_give_null_for_themselves_only(spark):
    df = spark.createDataFrame([(i, 5.0, float(i), i % 2, "s" if i % 2 else "t") for i in range(20)],
                               "id int, flat double, x double, y int, g string")
    out, _ = transforms.standardize(df, ["flat", "x"])
    assert out.filter("flat IS NOT NULL").count() == 0 and out.filter("x IS NULL").count() == 0
    t = {r.col_name: r.t for r in importance.welch_t(df, ["flat", "x"], "y").collect()}
    assert t["flat"] is None and t["x"] is not None
    corr = {r.col_name: r["corr"] for r in importance.abs_correlation(df, ["flat", "x"], "y").collect()}
    assert corr["flat"] is None and corr["x"] is not None
    f = {r.col_name: r.f for r in importance.anova_f(df.withColumn("h", F.col("g")), ["g"], "y").collect()}
    assert f == {"g": None}  # no spread inside the groups


def test_one_class_gives_null_curves(spark):
    scored = spark.createDataFrame([(1, i / 10, 1) for i in range(10)], "actual int, prob double, pred_class int")
    assert {r.specificity for r in evaluate.roc_points(scored).collect()} == {None}
    row = evaluate.auc(scored).first()
    assert row.auc is None and (row.n_pos, row.n_neg) == (10, 0)
    assert evaluate.lift_curve(scored).count() == 10
    assert evaluate.confusion_stats(evaluate.confusion_counts(scored)).first().kappa is None
    assert logistic.null_logit(scored, "actual").intercept == math.inf


def test_dotted_names_and_levels(spark):
    df = spark.createDataFrame([(1, None, "B.C"), (2, 2.0, "A"), (3, 6.0, None)], "id int, `x.y` double, `g.h` string")
    assert explore.numeric_summary(df, ["x.y"]).first().mean == 4.0
    assert {r.col_name: r.frac_missing for r in explore.missing_fraction(df).collect()}["g.h"] == pytest.approx(1 / 3)
    assert select.select_by_regex(df, "^x").columns == ["x.y"]
    assert select.select_by_position(df, [3]).columns == ["g.h"]
    flags = transforms.add_missing_flags(df, ["x.y"], suffix=".NA")
    assert [r["x.y.NA"] for r in flags.orderBy("id").collect()] == [1, 0, 0]
    dummies = transforms.add_dummies(df, transforms.dummy_levels(df, ["g.h"]))
    assert [r["g__h_B__C"] for r in dummies.orderBy("id").collect()] == [1, 0, None]


def test_power_transforms_apply_fitted_lambdas(spark):
    df = spark.createDataFrame([(4.0,), (0.0,), (-3.0,), (None,)], "x double")
    got = [r.x for r in transforms.apply_boxcox(df, {"x": 0.5}).collect()]
    assert got[0] == pytest.approx(2.0) and got[1:] == [None, None, None]
    assert transforms.apply_boxcox(df, {"x": 0.0}).first().x == pytest.approx(math.log(4))
    got = [r.x for r in transforms.apply_yeojohnson(df, {"x": 2.0}).collect()]
    assert got == [pytest.approx(12.0), pytest.approx(0.0), pytest.approx(-math.log(4)), None]
