"""Trees against a plain recursion, on one path of growth and the other."""

import random
from itertools import combinations

import numpy as np
import pytest

from quarry.operators import cart


def gini(n, k):
    return 2.0 * k * (n - k) / n if n else 0.0


def plain_tree(rows, nominal, min_split, min_bucket, max_depth, w, depth=0):
    """Best split of all by trying every cut and every subset of levels; nested tuples. rows: (bins, y, count)."""
    n0, n1 = sum(c for _, y, c in rows if not y), sum(c for _, y, c in rows if y)
    best = None
    if n0 and n1 and n0 + n1 >= min_split and (max_depth is None or depth < max_depth):
        whole = gini(n0 * w[0] + n1 * w[1], n1 * w[1])
        for i in range(len(rows[0][0])):
            values = sorted({b[i] for b, _, _ in rows})
            sets = ([set(s) for r in range(1, len(values)) for s in combinations(values, r)] if nominal[i]
                    else [set(values[:j]) for j in range(1, len(values))])
            for left in sets:
                l0 = sum(c for b, y, c in rows if not y and b[i] in left)
                l1 = sum(c for b, y, c in rows if y and b[i] in left)
                if min(l0 + l1, n0 + n1 - l0 - l1) < min_bucket:
                    continue
                gain = whole - gini(l0 * w[0] + l1 * w[1], l1 * w[1]) - gini(
                    (n0 - l0) * w[0] + (n1 - l1) * w[1], (n1 - l1) * w[1])
                if gain > (best[0] if best else 0.0) + 1e-9:
                    best = (gain, i, left)
    if not best:
        return (n0, n1)
    _, i, left = best
    sides = [[r for r in rows if (r[0][i] in left) == go] for go in (True, False)]
    return (n0, n1, round(best[0], 6), i, *(plain_tree(s, nominal, min_split, min_bucket, max_depth, w, depth + 1)
                                            for s in sides))


def nested(t, at=0):
    if t.input[at] < 0:
        return (int(t.n0[at]), int(t.n1[at]))
    return (int(t.n0[at]), int(t.n1[at]), round(float(t.gain[at]), 6), int(t.input[at]), nested(t, t.child[at]),
            nested(t, t.child[at] + 1))


def sizes(tree):
    """Shape of a tree whatever the side that a set split calls left."""
    if len(tree) == 2:
        return tree
    return (*tree[:4], *sorted(map(sizes, tree[4:]), key=str))


@pytest.mark.parametrize("seed", range(12))
def test_arrays_equal_the_plain_recursion(seed):
    rng = random.Random(seed)
    n, nominal = rng.randrange(20, 120), [False, False, True]
    rows = []
    for _ in range(n):
        b = (rng.randrange(12), rng.randrange(60), rng.randrange(5))
        rows.append((b, int(rng.random() < (0.2 + 0.5 * (b[0] > 6) + 0.2 * (b[2] in (1, 3)))), rng.choice([1, 1, 2])))
    least, bucket = rng.choice([(2, 1), (10, 3), (20, 7)])
    depth, w = rng.choice([None, 3]), rng.choice([(1.0, 1.0), (1.0, 3.5)])
    bins = np.array([r[0] for r in rows], np.uint8)
    y, count = np.array([r[1] for r in rows], np.uint8), np.array([r[2] for r in rows], np.uint8)
    got = cart.grow_arrays(bins, y, count, 0, "", None, 2, cart.Rules(least, bucket, depth, 0.0, w))
    assert sizes(nested(got)) == sizes(plain_tree(rows, nominal, least, bucket, depth, w))
    leaf = got.leaves(bins, 2)
    assert (np.bincount(leaf, count * y, len(got.input)) == np.where(got.input < 0, got.n1, 0)).all()


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        a, b, c = rng.random(), rng.gauss(0, 1), rng.choice(["p", "q", "r", "s", None])
        rows.append((i, a, b if i % 50 else None, c, int(rng.random() < 0.2 + 0.4 * (a > 0.6) + 0.3 * (c in ("q", "s")))))
    return spark.createDataFrame(rows, "id long, a double, b double, c string, y int")


def same(one, two):
    return all(np.array_equal(getattr(one, n), getattr(two, n)) for n in ("input", "n0", "n1", "gain", "sides"))


@pytest.mark.parametrize("rates,mtry", [(None, None), ((1.0, 1.0), 2), ((0.5, 2.0), 1)])
def test_large_nodes_give_the_same_trees(spark, table, rates, mtry):
    inputs = cart.Inputs.fit(table, ["a", "b"], ["c"])
    rows = cart.encode_rows(table.repartition(5), inputs, "y", "id")
    args = dict(n_trees=1 if rates is None else 3, mtry=mtry, rates=rates, rules=cart.Rules(4, 2, seed=9))
    local = cart.load_trees(spark, cart.grow_trees(rows, inputs, **args))
    split = cart.load_trees(spark, cart.grow_trees(rows, inputs, local_rows=250, **args))
    assert local.keys() == split.keys() and len(local) == args["n_trees"]
    for tree, one in local.items():
        two = split[tree]
        assert nested(one) == nested(two) and len(one.input) == len(two.input) > 20
        bins = np.random.default_rng(1).integers(0, 256, (500, 3)).astype(np.uint8)
        bins[:, 2] %= 6
        a, b = one.leaves(bins, 2), two.leaves(bins, 2)
        assert (one.n1[a] == two.n1[b]).all() and (one.n0[a] == two.n0[b]).all()


def test_growth_has_no_depth_cap():
    bins = np.arange(200, dtype=np.uint8)[:, None]
    y = (np.arange(200) % 2).astype(np.uint8)
    grown = cart.grow_arrays(bins, y, np.ones(200, np.uint8), 0, "", None, 1, cart.Rules())
    leaf = grown.leaves(bins, 1)
    assert len(set(leaf.tolist())) == 200 and (grown.events()[leaf] == y).all()


def test_counts_are_the_same_on_any_partitioning_and_follow_their_rates():
    h, y = np.arange(40_000).astype(np.int64), (np.arange(40_000) % 4 == 0).astype(int)
    count = cart.poisson_counts(h, y, 3, (0.25, 1.0), 5)
    back = cart.poisson_counts(h[::-1], y[::-1], 3, (0.25, 1.0), 5)[::-1]
    assert (count == back).all() and (count != cart.poisson_counts(h, y, 4, (0.25, 1.0), 5)).any()
    assert abs(count[y == 0].mean() - 0.25) < 0.02 and abs(count[y == 1].mean() - 1.0) < 0.04


def test_bins_of_missing_and_unknown_values(spark, table):
    import pyarrow as pa

    inputs = cart.Inputs({"a": [1.0, 2.0]}, {"c": ["p", "q"]})
    bins = inputs.bins([pa.array([0.5, 1.0, 1.5, 9.0, None]), pa.array(["p", "q", "z", None, "p"])])
    assert bins.tolist() == [[0, 0], [0, 1], [1, cart.UNKNOWN], [2, cart.UNKNOWN], [2, 0]]
    many = spark.range(300).selectExpr("cast(id as string) c")
    with pytest.raises(ValueError, match="levels"):
        cart.Inputs.fit(many, [], ["c"])


def test_bagged_rows_are_never_written(spark, table, monkeypatch):
    inputs = cart.Inputs.fit(table, ["a", "b"], ["c"])
    rows = cart.encode_rows(table.repartition(3), inputs, "y", "id")
    written, keep = [], cart.cut_lineage
    monkeypatch.setattr(cart, "cut_lineage", lambda df: written.append(keep(df)) or written[-1])
    path = cart.grow_trees(rows, inputs, 6, 2, (1.0, 1.0), cart.Rules(seed=3), local_rows=200)
    assert written and all("bins" not in df.columns and "rows" not in df.columns for df in written)
    assert sum(df.count() for df in written) < 6 * 2 * 900 / 200 * 3  # one row a large node or child


def test_packed_trees_are_small_and_come_back_whole():
    rng = np.random.default_rng(5)
    bins, y = rng.integers(0, 200, (20_000, 4)).astype(np.uint8), rng.integers(0, 2, 20_000).astype(np.uint8)
    bins[:, 3] %= 7
    grown = cart.grow_arrays(bins, y, np.ones(20_000, np.uint8), 0, "", 2, 3, cart.Rules(weights=(1.0, 2.5)))
    packed = cart.pack(grown, 3, (1.0, 2.5))
    assert len(packed) < 4 * len(grown.input)
    back = cart.unpack(packed)
    for name in ("input", "child", "n0", "n1", "gain"):
        assert np.array_equal(getattr(grown, name), getattr(back, name))
    assert np.array_equal(grown.leaves(bins, 3), back.leaves(bins, 3))


def test_node_of_a_tenth_of_a_gigabyte_is_one_task(spark, monkeypatch):
    """A tree of 70,000 rows is grown without a counting pass for every level of its large nodes."""
    passes, split = [], cart._split_large
    monkeypatch.setattr(cart, "_split_large", lambda *a: passes.append(1) or split(*a))
    df = spark.range(70_000).selectExpr("id", "cast(id % 211 as double) a", "cast(id % 7 = 0 as int) y")
    inputs = cart.Inputs.fit(df, ["a"])
    path = cart.grow_trees(cart.encode_rows(df, inputs, "y", "id"), inputs, rules=cart.Rules(max_depth=3))
    tree = cart.load_trees(spark, path)[0]
    assert not passes and (tree.n0[0], tree.n1[0]) == (60_000, 10_000)


def test_leaves_equal_a_walk_row_by_row():
    """Numbers and sets, over more rows than go down a tree together."""
    rng = np.random.default_rng(4)
    n = cart.WALKED_ROWS + 999
    bins = np.stack([rng.integers(0, 256, n), rng.integers(0, 6, n)], axis=1).astype(np.uint8)
    y = (rng.random(n) < 0.2 + 0.5 * ((bins[:, 0] > 90) ^ np.isin(bins[:, 1], [1, 4]))).astype(np.uint8)
    tree = cart.grow_arrays(bins[:3000], y[:3000], np.ones(3000, np.uint8), 0, "", None, 1, cart.Rules())
    assert (tree.input == 1).any()
    got = tree.leaves(bins, 1)
    for row in [*range(0, n, 97), n - 1]:
        at = 0
        while tree.input[at] >= 0:
            value, cut = bins[row, tree.input[at]], tree.cut[at]
            at = tree.child[at] + (not (tree.sides[cut, value] if tree.input[at] else value <= cut))
        assert got[row] == at
    assert (np.bincount(got[:3000], minlength=len(tree.n0)) == np.where(tree.input < 0, tree.n0 + tree.n1, 0)).all()
