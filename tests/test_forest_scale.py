"""Forests on many rows: the same trees however their nodes are split, and work that is dealt evenly."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import bagging, cart


def rows_of(n, seed=3):
    rng = np.random.default_rng(seed)
    bins = np.stack([rng.integers(0, 250, n), rng.integers(0, 9, n), rng.integers(0, 6, n), rng.integers(0, 90, n)], axis=1)
    bins[rng.random(n) < 0.05, 2] = cart.UNKNOWN
    bins[:, 3] += 70 * (rng.random(n) < 0.5)                     # a nominal input whose sets fill several words
    y = rng.random(n) < 0.1 + 0.3 * (bins[:, 0] > 120) + 0.3 * np.isin(bins[:, 2], [1, 4]) + 0.2 * (bins[:, 3] % 3 == 0)
    return bins.astype(np.uint8), y.astype(np.uint8), rng.integers(1, 4, n).astype(np.uint8)


@pytest.mark.parametrize("rules", [cart.Rules(seed=5), cart.Rules(20, 7, 6, seed=5), cart.Rules(weights=(1.0, 2.5), min_risk=3.0)])
@pytest.mark.parametrize("mtry", [None, 2])
def test_nodes_split_one_by_one_or_together_give_one_tree(monkeypatch, rules, mtry):
    bins, y, count = rows_of(4000)
    together = cart.grow_arrays(bins, y, count, 1, "LR", mtry, 2, rules)
    for counted, grown in ((100, 400), (1, 1), (900, 900)):
        monkeypatch.setattr(cart, "COUNTED_ROWS", counted)
        monkeypatch.setattr(cart, "GROWN_ROWS", grown)
        apart = cart.grow_arrays(bins, y, count, 1, "LR", mtry, 2, rules)
        for name in ("input", "child", "n0", "n1", "gain"):
            assert np.array_equal(getattr(together, name), getattr(apart, name))
        assert np.array_equal(together.leaves(bins, 2), apart.leaves(bins, 2))


def test_equal_sets_of_levels_are_kept_once_in_a_grown_tree():
    bins, y, count = rows_of(4000)
    tree = cart.grow_arrays(bins[:, :3], y, count, 0, "", 2, 2, cart.Rules())
    assert (tree.input == 2).sum() > len(tree.sides) == len(np.unique(tree.sides, axis=0))


def test_a_forest_needs_no_counting_pass_where_each_core_has_trees(spark, monkeypatch):
    passes, split = [], cart._split_large
    monkeypatch.setattr(cart, "_split_large", lambda *a: passes.append(1) or split(*a))
    monkeypatch.setattr(cart, "LOCAL_ROWS", 500)
    df = spark.range(2000).selectExpr("id", "cast(id % 211 as double) a", "cast(id % 7 = 0 as int) y")
    cores = spark.sparkContext.defaultParallelism
    bagging.fit(df, "y", "id", ["a"], [], cores)
    assert not passes
    monkeypatch.setattr(cart, "FOREST_LOCAL_ROWS", 500)
    bagging.fit(df, "y", "id", ["a"], [], cores)
    assert passes


def test_trees_are_dealt_evenly(spark):
    """As many trees as tasks: a task gets one, and a batch holds as many trees for every core."""
    batches = cart.tree_batches(500, 4_500_000, (1.0, 1.0), 8)
    assert {len(b) for b in batches[:-1]} == {24} and sum(map(len, batches)) == 500
    assert [len(b) for b in cart.tree_batches(10, 1000, None, 8)] == [10]
    df = spark.range(400).selectExpr("id", "cast(id % 31 as double) a", "cast(id % 7 = 0 as int) y")
    inputs = cart.Inputs.fit(df, ["a"])
    path = cart.grow_trees(cart.encode_rows(df, inputs, "y", "id"), inputs, 16, 1, (1.0, 1.0))
    a_file = spark.read.schema(cart.PIECE).parquet(path).groupBy(F.input_file_name()).count().collect()
    assert [r["count"] for r in a_file] == [1] * 16


def test_rows_of_one_file_are_scored_by_every_core(spark):
    df = spark.range(3000).coalesce(1).selectExpr("id", "cast(id % 31 as double) a", "cast(id % 7 = 0 as int) y")
    forest = bagging.fit(df, "y", "id", ["a"], [], 3)
    tasks = forest.transform(df).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == spark.sparkContext.defaultParallelism
    assert max(r["count"] for r in tasks) <= 2 * min(r["count"] for r in tasks)


def test_a_worker_keeps_no_block_of_trees(spark):
    blocks = [spark.sparkContext.broadcast({i: {"": bytes([i])}}) for i in range(3)]
    for turn in range(2):
        seen = []
        for number, _ in bagging._trees(blocks):
            seen.append(number)
            assert [i for i, b in enumerate(blocks) if "_value" in b.__dict__] == [number]
        assert seen == [0, 1, 2] and not any("_value" in b.__dict__ for b in blocks)


def test_a_large_node_table_is_pruned(spark):
    """More nodes than the two million at which a tree of 27 million rows was refused, pruned on the driver in time."""
    from quarry.operators import tree

    assert tree.MAX_NODES >= 2 * 27_000_000 // 7
    half = 1 << 20                                                # a full tree of 2,097,151 nodes
    size = 2 * half - 1
    split = np.arange(size) < half - 1
    rng = np.random.default_rng(2)
    n, k = np.zeros(size), np.zeros(size)
    n[half - 1:], k[half - 1:] = 20, rng.integers(0, 21, half)
    for first in (2 ** d - 1 for d in range(19, -1, -1)):
        at = np.arange(first, 2 * first + 1)
        n[at], k[at] = n[2 * at + 1] + n[2 * at + 2], k[2 * at + 1] + k[2 * at + 2]
    left = np.where(split, 2 * np.arange(size) + 1, -1)
    path = tree.pruning_path(tree.CartNodes(n, k, left, np.where(split, 0, -1), np.zeros(size)))
    assert path[0].n_leaves == half and path[-1].n_leaves == 1
    assert path[-1].rel_error == 1.0 and path[0].rel_error < 1.0


def test_encoded_rows_are_packed_and_those_without_a_target_left_out(spark):
    df = spark.range(1000).selectExpr(
        "id", "cast(id % 31 as double) a", "cast(id % 5 as string) c", "if(id % 10 = 9, null, cast(id % 7 = 0 as int)) y")
    inputs = cart.Inputs.fit(df, ["a"], ["c"])
    encoded = cart.encode_rows(df.repartition(3), inputs, "y", "id")
    want = {r["h"]: (r["y"], r["a"], r["c"]) for r in df.filter("y is not null").select(F.xxhash64("id").alias("h"), "y", "a", "c").collect()}
    blocks = encoded.toArrow()
    assert len(blocks) < 30 and cart.class_counts(encoded) == (
        sum(y == 0 for y, _, _ in want.values()), sum(y == 1 for y, _, _ in want.values()))
    got = {}
    for h, y, columns in cart._unpacked(blocks.column("packed").combine_chunks(), 2):
        got |= {k: (t, inputs.cuts["a"][a], inputs.levels["c"][c]) for k, t, a, c in zip(h.tolist(), y.tolist(), *columns.tolist())}
    assert got == want


def test_files_of_shuffles_go_until_the_last_thread_is_done(spark):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    from quarry.session import shuffles_dropped

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, meet, apart = spark.conf.get(name, None), Barrier(2), Barrier(2)

    def one(first):
        with shuffles_dropped(spark):
            meet.wait(20)
            if first:
                apart.wait(20)      # the other one is still inside
                return spark.conf.get(name)
            apart.wait(20)
            apart.wait(20)
            return spark.conf.get(name)

    with ThreadPoolExecutor(2) as pool:
        both = [pool.submit(one, x) for x in (True, False)]
        both[0].result(20)
        assert spark.conf.get(name, None) == "true"
        apart.wait(20)
        assert both[1].result(20) == "true"
    assert spark.conf.get(name, None) == before
