"""Exact distributed quantiles and trimmed means against numpy on random data with ties and NULLs."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators import explore

values = st.lists(st.one_of(st.none(), st.integers(-20, 20).map(float), st.floats(-1e3, 1e3, allow_nan=False)),
                  min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(xs=values, ys=values)
def test_quantiles_match_numpy(spark, xs, ys):
    n = max(len(xs), len(ys))
    xs, ys = xs + [None] * (n - len(xs)), ys + [None] * (n - len(ys))
    df = spark.createDataFrame(list(zip(range(n), xs, ys)), "id long, x double, y double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = explore.exact_quantiles(df, ["x", "y"], probs)
    for c, col in (("x", xs), ("y", ys)):
        vals = [v for v in col if v is not None]
        if not vals:
            assert all(q is None for q in got[c])
            continue
        ref = np.percentile(np.array(vals), [p * 100 for p in probs])
        for g, r in zip(got[c], ref):
            assert math.isclose(g, r, rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=10, deadline=None)
@given(xs=st.lists(st.integers(0, 5).map(float), min_size=1, max_size=50))
def test_trimmed_mean_matches_sorted_slice(spark, xs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(xs)], "id long, x double")
    row = explore.trimmed_mean_mad(df, ["x"]).collect()[0]
    s = sorted(xs)
    k = int(math.floor(len(s) * 0.1))
    kept = s[k:len(s) - k]
    assert math.isclose(row["trimmed_mean"], sum(kept) / len(kept), rel_tol=1e-12)
    med = float(np.median(s))
    assert math.isclose(row["median"], med, rel_tol=1e-12)
    assert math.isclose(row["mad"], 1.4826 * float(np.median([abs(v - med) for v in s])), rel_tol=1e-9, abs_tol=1e-12)
