from pyspark.sql import functions as F

from quarry.operators import sampling


def test_stratified_split_exact_shares(spark):
    rows = [(i, 1 if i % 5 == 0 else 0) for i in range(1001)]
    df = spark.createDataFrame(rows, "id long, y int")
    s = sampling.stratified_split(df, "y", "id", (0.5, 0.25), ("train", "valid", "test"), seed=3)
    counts = {(r["y"], r["split"]): r["n"] for r in s.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    n1, n0 = 201, 800
    assert counts[(1, "train")] == int(0.5 * n1 + 0.5)
    assert counts[(1, "train")] + counts[(1, "valid")] == int(0.75 * n1 + 0.5)
    assert counts[(0, "train")] == 400 and counts[(0, "valid")] == 200 and counts[(0, "test")] == 200
    # Deterministic: same seed, same split.
    again = sampling.stratified_split(df, "y", "id", (0.5, 0.25), ("train", "valid", "test"), seed=3)
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, again.collect()))


def test_downsample_and_weights(spark):
    df = spark.createDataFrame([(i, 1 if i < 10 else 0) for i in range(100)], "id long, y int")
    d = sampling.downsample(df, "y", "id", seed=1)
    assert {r["y"]: r["n"] for r in d.groupBy("y").agg(F.count("*").alias("n")).collect()} == {0: 10, 1: 10}
    w = sampling.inverse_prior_weights(df, "y").groupBy("y").agg(F.first("weight").alias("w")).collect()
    assert {r["y"]: round(r["w"], 6) for r in w} == {0: round(100 / 90, 6), 1: 10.0}


def test_single_class_split(spark):
    df = spark.createDataFrame([(i, 0) for i in range(10)], "id long, y int")
    s = sampling.stratified_split(df, "y", "id", (0.5,), ("train", "valid"), seed=1)
    assert s.filter(F.col("split") == "train").count() == 5
