"""Property tests (hypothesis): operators agree with brute force on random inputs."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from credal.operators import evaluate as M
from credal.operators.quantiles import exact_quantiles

SETTINGS = dict(max_examples=5, deadline=None)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=1, max_size=200),
       st.integers(2, 30))
def test_sweep_counts_match_bruteforce(spark, rows, n):
    df = spark.createDataFrame([(y, s / 20.0) for y, s in rows], "y int, p double")
    got = {r.j: (r.tp, r.fp, r.fn, r.tn) for r in M.threshold_sweep(df, "p", "y", n=n, lo=0.05, hi=0.8).collect()}
    y = np.array([r[0] for r in rows])
    p = np.array([r[1] / 20.0 for r in rows])
    for j, t in enumerate(M.linspace(0.05, 0.8, n)):
        pred = p >= t
        assert got[j] == (int(np.sum(pred & (y == 1))), int(np.sum(pred & (y == 0))),
                          int(np.sum(~pred & (y == 1))), int(np.sum(~pred & (y == 0))))


@settings(**SETTINGS)
@given(st.lists(st.integers(0, 2), min_size=5, max_size=300), st.floats(0.05, 0.5))
def test_split_sizes_exact(spark, labels, frac):
    df = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "id int, y int")
    s = M.stratified_split(df, "y", ["id"], frac, seed=7)
    got = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    size = math.ceil(frac * len(labels))
    assert sum(n for (_, part), n in got.items() if part == "test") == size
    for y in set(labels):
        n = labels.count(y)
        assert abs(got.get((y, "test"), 0) - n * size / len(labels)) < 1
        assert got.get((y, "test"), 0) + got.get((y, "train"), 0) == n


@settings(**SETTINGS)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=300),
       st.lists(st.floats(0, 1), min_size=1, max_size=5))
def test_exact_quantiles_match_numpy(spark, values, probs):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, ["v"], probs, accuracy=20)["v"]
    assert np.allclose(got, np.quantile(np.array(values), probs), rtol=1e-9, atol=1e-6)


@settings(**SETTINGS)
@given(st.lists(st.integers(-50, 50), min_size=2, max_size=120), st.lists(st.integers(-50, 50), min_size=2, max_size=120))
def test_ks_matches_numpy(spark, a, b):
    from credal.operators import monitor as D
    ref = spark.createDataFrame([(float(v),) for v in a], "v double")
    cur = spark.createDataFrame([(float(v),) for v in b], "v double")
    got = D.numeric_drift(ref, cur, ["v"], buckets=3).first().ks
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert abs(got - np.max(np.abs(fa - fb))) < 1e-12
