"""Hand-made edge cases and brute-force comparisons for the operators."""

import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from credal.functions import clean as C
from credal.operators import aggregate as A
from credal.operators import assemble as J
from credal.operators import evaluate as M
from credal.operators import monitor as D
from credal.operators import preprocess as P
from credal.operators import profile as Q
from credal.operators import train as TR
from credal.operators.cumulative import cumulative_sums
from credal.sources import io


# cleaning ---------------------------------------------------------------------------
def test_recode_tokens_coerce_bucketize(spark):
    df = spark.createDataFrame([(" active ", "None", "3.5", 5.0), ("CLOSED", "nan", "x", 0.0), (None, "7", "nan", -2.0)],
                               "s string, tok string, num string, v double")
    out = df.select(
        C.value_map_recode("s", {"Active": "active", "Closed": "closed"}, "unknown").alias("r"),
        C.scrub_null_tokens("tok").alias("t"), C.coerce_numeric("num").alias("n"),
        C.bucketize("v", [-5.0, 0.0, 5.0]).alias("b"), C.clip_at_zero("v").alias("c")).collect()
    assert [r.r for r in out] == ["active", "closed", "unknown"]
    assert [r.t for r in out] == [None, None, "7"]
    assert out[0].n == 3.5 and out[1].n is None and out[2].n is None  # 'nan' → NULL, not NaN
    assert [r.b for r in out] == [1, 0, 0]  # right-closed: 0.0 falls in (-5, 0]
    assert [r.c for r in out] == [5.0, 0.0, 0.0]


def test_clip_null_and_row_functions(spark):
    df = spark.createDataFrame([(None, 1.0, None), (2.0, None, 4.0)], "a double, b double, c double")
    r = df.select(C.clip_at_zero("a").alias("z"), C.mean_of_available("a", "b", "c").alias("m"),
                  C.row_min("a", "b", "c").alias("lo")).collect()
    assert r[0].z == 0 and r[0].m == 1.0 and r[0].lo == 1.0
    assert r[1].m == 3.0 and r[1].lo == 2.0


# preprocessing ------------------------------------------------------------------------
def _fit_frame(spark):
    rows = [(1.0, 5.0, 2.0, None, "a", "x", 1), (2.0, 5.0, 2.0, None, "b", "x", 0), (None, 5.0, 2.0, None, "b", "y", 1),
            (4.0, 5.0, 2.0, None, None, "y", 0), (10.0, 5.0, 9.0, None, "a", "x", 0)]
    return spark.createDataFrame(rows, "x double, const double, iqr0 double, allnull double, cat string, te string, y int")


def test_fit_edge_cases(spark):
    df = _fit_frame(spark)
    spec = P.PreprocessSpec(standard=["x", "const", "allnull"], robust=["iqr0"], one_hot=["cat"], ordinal=["cat2"],
                            target_enc=["te"], target="y", smoothing=1.0)
    p = P.fit(df, spec)
    assert "allnull" in p.dropped
    assert p.scales["const"] == 1.0                     # σ = 0 → 1
    assert p.robust_scales["iqr0"] == 1.0               # IQR = 0 → 1
    assert p.medians["x"] == 3.0                        # median of 1, 2, 4, 10
    assert p.indicators == ["x"]
    assert p.categories["cat"] == ["a", "b", "unknown"]
    # imputed column: 1, 2, 3, 4, 10 → mean 4, population σ
    assert p.means["x"] == pytest.approx(4.0)
    assert p.scales["x"] == pytest.approx(np.std([1, 2, 3, 4, 10]))
    new = spark.createDataFrame([(None, 5.0, 2.0, None, "zzz", "never", 0)], df.schema)
    out = P.transform(new, p).first().asDict()
    assert out["ohe__cat_a"] == 0 and out["ohe__cat_b"] == 0 and out["ohe__cat_unknown"] == 0  # unseen → zeros
    assert out["target_enc__te"] == pytest.approx(p.te_global)                                # unseen → global
    glob = 2 / 5
    assert p.te_maps["te"]["x"] == pytest.approx((3 * (1 / 3) + glob) / 4)


def test_params_roundtrip_and_partition_independence(spark):
    df = _fit_frame(spark)
    spec = P.PreprocessSpec(standard=["x"], log=["iqr0"], one_hot=["cat"], target_enc=["te"], target="y")
    p = P.fit(df, spec)
    p2 = P.Params.from_json(p.to_json())
    a = sorted(map(tuple, P.transform(df, p).collect()))
    b = sorted(map(tuple, P.transform(df.repartition(3), p2).collect()))
    assert a == b
    p3 = P.fit(df.repartition(4), spec)  # same parameters up to float summation order
    _approx_equal(json.loads(p3.to_json()), json.loads(p.to_json()))


def _approx_equal(a, b):
    if isinstance(a, dict):
        assert a.keys() == b.keys()
        for k in a:
            _approx_equal(a[k], b[k])
    elif isinstance(a, list):
        assert len(a) == len(b)
        for x, y in zip(a, b):
            _approx_equal(x, y)
    elif isinstance(a, float):
        assert a == pytest.approx(b, rel=1e-12)
    else:
        assert a == b


def test_out_of_fold_never_uses_own_fold(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice("abcd"), rng.randint(0, 1), i % 4) for i in range(400)]
    rows.append((999, "solo", 1, 2))  # a category present in one fold only → global mean
    df = spark.createDataFrame(rows, "id int, cat string, y int, fold int")
    got = {r.id: r.cat_oof for r in P.out_of_fold_target_encoding(df, "cat", "y", "fold", "cat_oof").collect()}
    pdf = pd.DataFrame(rows, columns=["id", "cat", "y", "fold"])
    glob = pdf.y.mean()
    for rid, cat, _y, fold in rows:
        other = pdf[(pdf["cat"] == cat) & (pdf["fold"] != fold)]
        exp = other["y"].mean() if len(other) else glob
        assert got[rid] == pytest.approx(exp)


# splits and folds ---------------------------------------------------------------------
def test_stratified_split_exact_disjoint_partition_independent(spark):
    rows = [(i, 1 if i % 13 == 0 else 0) for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, y int")
    s1 = M.stratified_split(df, "y", ["id"], 0.2, seed=3)
    s2 = M.stratified_split(df.repartition(7), "y", ["id"], 0.2, seed=3)
    c = {(r.y, r.split): r["count"] for r in s1.groupBy("y", "split").count().collect()}
    n1 = sum(1 for _, y in rows if y == 1)
    assert c[(1, "test")] == round(n1 * 0.2) and c[(0, "test")] == round((5000 - n1) * 0.2)
    a = {r.id for r in s1.where("split = 'test'").collect()}
    b = {r.id for r in s2.where("split = 'test'").collect()}
    assert a == b


def test_folds_balanced(spark):
    df = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(1003)], "id int, y int")
    f = M.stratified_folds(df, "y", ["id"], k=5)
    sizes = f.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        s = [r["count"] for r in sizes if r.y == y]
        assert len(s) == 5 and max(s) - min(s) <= 1


def test_rank_thresholds_vs_sort(spark):
    rng = random.Random(5)
    vals = [(rng.choice([0, 1]), rng.randint(-2**63, 2**63 - 1)) for _ in range(3000)]
    df = spark.createDataFrame(vals, "g int, h long")
    targets = {0: [1, 17, 500], 1: [3, 1000]}
    th = M.rank_thresholds(df, "g", "h", targets)
    for g, ts in targets.items():
        srt = sorted(h for gg, h in vals if gg == g)
        assert th[g] == [srt[t - 1] for t in ts]


# threshold sweep and ranking metrics -----------------------------------------------
def _scores(n=3000, seed=11):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    p = np.clip(np.round(rng.random(n) * 0.6 + 0.3 * y, 2), 0, 1)  # rounded: many ties
    return y, p


def test_threshold_sweep_vs_bruteforce(spark):
    y, p = _scores()
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    sw = {r.j: r for r in M.threshold_sweep(df, "p", "y", n=150).collect()}
    for j, t in enumerate(M.linspace(0.05, 0.80, 150)):
        pred = p >= t
        assert sw[j].tp == int(np.sum(pred & (y == 1))) and sw[j].fp == int(np.sum(pred & (y == 0)))
        assert sw[j].cost == 10 * int(np.sum(~pred & (y == 1))) + int(np.sum(pred & (y == 0)))


def test_auc_and_ap_vs_bruteforce(spark):
    y, p = _scores(800)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    auc = M.roc_auc(df, "p", "y", buckets=5).first()[0]
    pos, neg = p[y == 1], p[y == 0]
    exp = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert auc == pytest.approx(exp)
    ap = M.average_precision(df, "p", "y", buckets=5).first()[0]
    order = np.argsort(-p, kind="stable")
    exp_ap, P_ = 0.0, y.sum()
    for s in np.unique(p)[::-1]:
        sel = p >= s
        prec = y[sel].sum() / sel.sum()
        exp_ap += (y[p == s].sum() / P_) * prec
    assert ap == pytest.approx(exp_ap)
    assert len(order) == len(p)


def test_cumulative_sums_vs_pandas(spark):
    rng = random.Random(2)
    rows = [(g, k, rng.randint(0, 9)) for g in ("a", "b") for k in rng.sample(range(10000), 700)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    for desc in (False, True):
        got = {(r.g, r.k): r.cum_v for r in cumulative_sums(df, "k", ["v"], partition=["g"], descending=desc,
                                                             buckets=7).collect()}
        pdf = pd.DataFrame(rows, columns=["g", "k", "v"]).sort_values(["g", "k"], ascending=[True, not desc])
        pdf["c"] = pdf.groupby("g").v.cumsum()
        for r in pdf.itertuples():
            assert got[(r.g, r.k)] == r.c


# joins ----------------------------------------------------------------------------------
def test_radius_counts_vs_bruteforce_with_hot_spot(spark):
    rng = random.Random(4)
    pts = [(i, rng.uniform(0, 1), rng.uniform(0, 1)) for i in range(300)]
    pts += [(1000 + i, 0.5 + rng.uniform(-0.01, 0.01), 0.5 + rng.uniform(-0.01, 0.01)) for i in range(300)]  # dense
    pts += [(2000 + i, 0.25, 0.75) for i in range(200)]  # copies of one location
    df = spark.createDataFrame(pts, "id int, x double, y double")
    radii = [0.02, 0.05, 0.1]
    got = {r.id: r for r in J.radius_neighbour_counts(df, df, radii).collect()}
    for i, x, y in pts[::17]:
        for r in radii:
            exp = sum(1 for _, a, b in pts if math.sqrt((x - a) ** 2 + (y - b) ** 2) <= r)
            assert got[i][f"n_within_{str(r).replace('.', '_')}"] == exp


def test_first_per_group_and_last_n(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("a", 1, 2.0), ("b", 5, 3.0), ("b", 2, 4.0)], "g string, id int, v double")
    r = {x.g: (x.id, x.v) for x in A.first_per_group(df, "g", "id").collect()}
    assert r == {"a": (1, 2.0), "b": (2, 4.0)}
    assert [x.id for x in A.last_n(df, "id", 2).collect()] == [5, 3]


# monitoring ----------------------------------------------------------------------------
def test_ks_and_wasserstein_vs_numpy(spark):
    rng = np.random.default_rng(0)
    a, b = np.round(rng.normal(0, 1, 400), 2), np.round(rng.normal(0.3, 1.2, 500), 2)
    ref = spark.createDataFrame([(float(v),) for v in a], "v double")
    cur = spark.createDataFrame([(float(v),) for v in b], "v double")
    r = D.numeric_drift(ref, cur, ["v"], buckets=5).first()
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert r.ks == pytest.approx(np.max(np.abs(fa - fb)))
    w = np.sum(np.abs(fa - fb)[:-1] * np.diff(grid))
    assert r.wasserstein_norm == pytest.approx(w / np.std(a))


def test_quarantine_split_and_skewness(spark):
    df = spark.createDataFrame([(0.5, 30, "F"), (0.99, 30, "M"), (0.2, 10, "X")], "e double, age int, g string")
    valid, quarantine = io.quarantine_split(df, {"e": (0.01, 0.96), "age": (18, 70), "g": ["F", "M"]})
    assert valid.count() == 1
    assert sorted(map(len, [r.failed_rules for r in quarantine.collect()])) == [1, 2]
    vals = [1.0, 2.0, 2.0, 3.0, 10.0, 11.0]
    prof = Q.numeric_profile(spark.createDataFrame([(v,) for v in vals], "v double")).first()
    s = pd.Series(vals)
    assert prof.skewness == pytest.approx(s.skew()) and prof.kurtosis == pytest.approx(s.kurt())


def test_oversampling_exact(spark):
    df = spark.createDataFrame([(i, int(i < 37)) for i in range(1000)], "id int, y int")
    out = TR.oversample_minority(df, "y", ["id"], ratio=0.3, minority=1)
    c = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert c[1] == int(0.3 * 963) and c[0] == 963


def test_exact_quantiles_selection_vs_numpy(spark):
    from credal.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.normal(0, 1, 3000), np.full(2500, 0.25), rng.exponential(3, 500)])  # a hot value
    b = np.round(rng.random(6000) * 100, 2)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for kw in ({}, {"accuracy": 100}, {"accuracy": 10}):  # rough sketches need several rounds
        got = exact_quantiles(df, ["a", "b"], probs, **kw)
        for c, arr in (("a", a), ("b", b)):
            assert np.allclose(got[c], np.quantile(arr, probs), rtol=1e-12, atol=1e-12)


def test_cumulative_next_key(spark):
    rng = random.Random(9)
    rows = [(g, k, 1) for g in ("a", "b") for k in rng.sample(range(5000), 400)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    for desc in (False, True):
        got = {(r.g, r.k): r.next_k for r in cumulative_sums(df, "k", ["v"], partition=["g"], descending=desc,
                                                              buckets=6, with_next=True).collect()}
        for g in ("a", "b"):
            ks = sorted((k for gg, k, _ in rows if gg == g), reverse=desc)
            for a, b in zip(ks, ks[1:] + [None]):
                assert got[(g, a)] == b


def test_modes_tie_smallest_and_imputation(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", None), ("b", 3.0), ("a", 2.0), (None, 10.0)], "c string, x double")
    modes = {r.column: (r.mode, r["count"]) for r in A.column_modes(df, ["c"]).collect()}
    assert modes["c"] == ("a", 2)  # a and b tie at 2 → smallest
    vals = P.fit_imputation(df, numeric=["x"], categorical=["c"])
    assert vals == {"x": 2.5, "c": "a"}
    out = df.select(*P.impute_exprs(df, vals)).collect()
    assert [r.c for r in out] == ["b", "a", "b", "a", "a"] and out[1].x == 2.5


def test_registry_select_and_validation(spark):
    from credal.registry import AttributeSpec, FeatureRegistry, validate_columns
    reg = FeatureRegistry([
        AttributeSpec("id", "t", "identifier", role="identifier", raw_name="ID"),
        AttributeSpec("y", "t", "binary", role="target", raw_name="Y"),
        AttributeSpec("status", "t", "categorical", value_map={"Active": "active"}, unknown_value="unknown"),
        AttributeSpec("flag", "t", "binary"), AttributeSpec("amt", "t", "numerical", transform="log"),
        AttributeSpec("amt", "other", "numerical")])  # same name, other table: no leak
    assert reg.columns(table="t", transform="log") == ["amt"]
    df = spark.createDataFrame([("7", "1", " active ", "Y", "3.5"), ("8", "0", "gone", "N", "x")],
                               "id string, y string, status string, flag string, amt string")
    tr = df.select(*reg.select_exprs("t")).collect()
    te = df.select(*reg.select_exprs("t", is_test=True)).collect()
    assert [(r.id, r.y, r.status, r.flag, r.amt) for r in tr] == [(7, 1, "active", 1, 3.5), (8, 0, "unknown", 0, None)]
    assert [r.y for r in te] == [None, None]
    issues = {(r.column, r.issue) for r in validate_columns(spark, reg, ["ID", "Status", "extra"], tables=["t"]).collect()}
    assert ("extra", "unknown") in issues and ("amt", "missing") in issues and ("id", "missing") not in issues
    assert FeatureRegistry.from_json(reg.to_json()).to_json() == reg.to_json()


def test_key_indicators_vs_pandas(spark):
    rng = np.random.default_rng(1)
    p = rng.random(500)
    lat = np.round(rng.exponential(5, 500), 2)
    dec = np.where(p < 0.3, "approved", "refused")
    df = spark.createDataFrame([(float(a), float(b), str(c)) for a, b, c in zip(p, lat, dec)],
                               "probability double, latency_ms double, decision string")
    r = D.key_indicators(df).first()
    assert r.total == 500 and r.refusals == int((dec == "refused").sum())
    assert r.latency_p95 == pytest.approx(np.quantile(lat, 0.95))
    assert r.refusal_rate == pytest.approx((dec == "refused").mean())


def test_hot_key_third_of_rows(spark):
    """One key holds a third of the rows: aggregates, master join, out-of-fold
    encoding and the stratified split stay exact."""
    rng = random.Random(3)
    rows = [(0 if i % 3 == 0 else rng.randint(1, 500), i, rng.randint(0, 1), float(rng.randint(1, 100)))
            for i in range(6000)]
    hist = spark.createDataFrame(rows, "k int, id int, y int, v double").repartition(6)
    base = spark.createDataFrame([(k,) for k in range(0, 501)], "k int")
    agg = A.spec_aggregate(hist, "k", {"v": ["sum", "size", "nunique"]})
    m = {r.k: r for r in J.master_join(base, [agg], "k").collect()}
    pdf = pd.DataFrame(rows, columns=["k", "id", "y", "v"])
    g = pdf.groupby("k")
    for k in (0, 1, 250):
        if k in g.groups:
            assert m[k].V_SUM == g.v.sum()[k] and m[k].V_SIZE == g.size()[k] and m[k].V_NUNIQUE == g.v.nunique()[k]
    folds = hist.withColumn("fold", F.col("id") % 5)
    oof = {r.id: r.k_oof for r in P.out_of_fold_target_encoding(
        folds.withColumn("kc", F.col("k").cast("string")), "kc", "y", "fold", "k_oof").collect()}
    sub = pdf[(pdf.k == 0) & (pdf.id % 5 != 0)]
    assert oof[0] == pytest.approx(sub.y.mean())
    s = M.stratified_split(hist, "y", ["id"], 0.25)
    c = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    for y in (0, 1):
        assert c[(y, "test")] == round((pdf.y == y).sum() * 0.25)


def test_grouped_exact_quantiles_vs_numpy(spark):
    from credal.operators.quantiles import grouped_exact_quantiles
    rng = np.random.default_rng(5)
    g = rng.integers(0, 4, 3000)
    v = np.where(g == 0, 7.0, np.round(rng.normal(0, 10, 3000), 1))  # group 0: one repeated value
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)], "g int, v double")
    probs = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {r.g: [r[f"q{j}"] for j in range(5)]
           for r in grouped_exact_quantiles(df, ["g"], "v", probs, [f"q{j}" for j in range(5)], buckets=3).collect()}
    for k in range(4):
        assert np.allclose(got[k], np.quantile(v[g == k], probs), rtol=1e-12, atol=1e-12)


def test_jsonl_reader_counts_good_and_corrupt(spark):
    base = io.scratch_dir(spark, "jsonl-test")
    e = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, s string")
    io.append_jsonl(e, base)
    spark.createDataFrame([('{"id": 4, "s": ',), ("",), ("not json",)], "line string").write.mode("append").text(base)
    good, bad = io.read_jsonl(spark, base, e.schema)
    assert good.count() == 3 and bad.count() == 2
    assert sorted(r.id for r in good.collect()) == [1, 2, 3]


def test_results_independent_of_partitioning(spark):
    y, p = _scores(1500, seed=21)
    rows = [(int(a), float(b)) for a, b in zip(y, p)]
    one = spark.createDataFrame(rows, "y int, p double").coalesce(1)
    many = spark.createDataFrame(rows, "y int, p double").repartition(9)
    assert sorted(map(tuple, M.threshold_sweep(one, "p", "y", 40).collect())) == \
        sorted(map(tuple, M.threshold_sweep(many, "p", "y", 40).collect()))
    assert M.roc_auc(one, "p", "y", 4).first()[0] == pytest.approx(M.roc_auc(many, "p", "y", 7).first()[0])
    ref, cur = one.where("y = 0"), many.where("y = 1")
    a = D.numeric_drift(ref, cur, ["p"], buckets=3).first()
    b = D.numeric_drift(ref.repartition(5), cur.coalesce(1), ["p"], buckets=11).first()
    assert a.ks == pytest.approx(b.ks) and a.psi == pytest.approx(b.psi) and a.js == pytest.approx(b.js)
    assert a.wasserstein_norm == pytest.approx(b.wasserstein_norm)


def test_drift_pvalues(spark):
    from credal.functions.stats import _gammaincc
    assert _gammaincc(0.5, 3.841458820694124 / 2) == pytest.approx(0.05, abs=1e-9)      # χ²(1) 95 %
    assert _gammaincc(2.0, 9.487729036781154 / 2) == pytest.approx(0.05, abs=1e-9)      # χ²(4) 95 %
    from credal.functions.stats import ks_pvalue
    row = spark.createDataFrame([(0.0, 10, 10), (1.0, 50, 50)], "d double, a long, b long") \
        .select(ks_pvalue(F.col("d"), F.col("a"), F.col("b")).alias("p")).collect()
    assert row[0].p == 1.0 and row[1].p < 1e-10


def test_linear_contributions_vs_numpy(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(0, 1, (300, 3))
    y = (X[:, 0] + 0.5 * X[:, 1] - X[:, 2] + rng.normal(0, 0.5, 300) > 0).astype(int)
    rows = [(i, float(a), float(b), float(c), int(t)) for i, ((a, b, c), t) in enumerate(zip(X, y))]
    df = spark.createDataFrame(rows, "id int, ohe__g_a double, ohe__g_b double, standard__x double, y int")
    feats = ["ohe__g_a", "ohe__g_b", "standard__x"]
    model = TR.fit_model(df, feats, TR.model_catalogue(TR.weighted_rows(df), "y", None)["logistic"])
    means = TR.column_means(df, feats)
    src = {"ohe__g_a": "g", "ohe__g_b": "g", "standard__x": "x"}
    top, glob = TR.linear_contributions(df, model, feats, means, "id", src, top=1)
    coef = model.stages[-1].coefficients.toArray()
    mu = np.array([means[f] for f in feats])
    contrib = (X - mu) * coef
    g, x = contrib[:, 0] + contrib[:, 1], contrib[:, 2]
    got = {r.id: (r.source, r.impact) for r in top.collect()}
    for i in range(0, 300, 37):
        exp = ("g", g[i]) if (abs(g[i]) > abs(x[i]) or (abs(g[i]) == abs(x[i]))) else ("x", x[i])
        assert got[i][0] == exp[0] and got[i][1] == pytest.approx(exp[1])
    gm = {r.source: r.mean_abs_impact for r in glob.collect()}
    assert gm["g"] == pytest.approx(np.mean(np.abs(g))) and gm["x"] == pytest.approx(np.mean(np.abs(x)))


def test_best_threshold_first_on_cost_ties(spark):
    # every score above the grid: all thresholds predict positive → identical costs
    df = spark.createDataFrame([(1, 0.95), (0, 0.9), (1, 0.99)], "y int, p double")
    best = M.best_threshold(M.threshold_sweep(df, "p", "y", n=10)).first()
    assert best.j == 0 and best.cost == 1
    f2 = M.best_threshold(M.threshold_sweep(df, "p", "y", n=10), by="f2").first()
    assert f2.j == 0


def test_small_sample_moments_and_alignment(spark):
    prof = {r.column: r for r in Q.numeric_profile(
        spark.createDataFrame([(1.0, 1.0), (2.0, 5.0)], "a double, b double")).collect()}
    assert prof["a"].skewness is None and prof["a"].kurtosis is None      # n < 3 / n < 4
    test = spark.createDataFrame([(1.0, "x", 7.0)], "f1 double, extra string, f3 double")
    out = J.align_columns(test, ["f3", "f2", "f1"])
    assert out.columns == ["f3", "f2", "f1"] and tuple(out.first()) == (7.0, 0.0, 1.0)


def test_ordinal_categories_from_maps_only_when_all_have_one(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), (None, "x")], "o1 string, o2 string")
    both = P.fit(df, P.PreprocessSpec(ordinal=["o1", "o2"], ordinal_categories={"o1": ["z", "b", "a"], "o2": ["y", "x"]}))
    assert both.ordinal_categories == {"o1": ["a", "b", "z"], "o2": ["x", "y"]}
    partial = P.fit(df, P.PreprocessSpec(ordinal=["o1", "o2"], ordinal_categories={"o1": ["z", "b", "a"]}))
    assert partial.ordinal_categories == {"o1": ["a", "b", "unknown"], "o2": ["x", "y"]}
    out = P.transform(spark.createDataFrame([("z", "q")], df.schema), partial).first()
    assert out["ordinal__o1"] == -1.0 and out["ordinal__o2"] == -1.0      # unseen → −1


def test_grouped_quantiles_keep_null_group(spark):
    from credal.operators.quantiles import grouped_exact_quantiles
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 7.0), (None, 9.0)], "g string, v double")
    got = {r.g: r.p50 for r in grouped_exact_quantiles(df, ["g"], "v", [0.5], ["p50"], buckets=2).collect()}
    assert got == {"a": 2.0, None: 7.0}
    out = {r.g: (r.p50, r["max"]) for r in A.percentiles(df, "v", [0.5], keys=["g"], names=["p50"]).collect()}
    assert out == {"a": (2.0, 3.0), None: (7.0, 9.0)}


def test_percent_and_two_value_detection(spark):
    df = spark.createDataFrame([("5 %", "Y", "a", 1), ("7,5%", "N", "b", 2), ("x", "Y", "c", 1)],
                               "p string, yn string, s string, k int")
    assert Q.percent_columns(df) == ["p"]
    assert Q.two_value_columns(df) == ["yn", "k"]


def test_infer_registry_rules_and_sample(spark):
    df = spark.createDataFrame([(i, float(i) * 10, "A" if i % 2 else "B", "Y" if i % 3 else "N", i % 7)
                                for i in range(200)], "SK_ID_CURR long, AMT_CREDIT double, NAME string, FLAG_X string, CNT_SOCIAL_CIRCLE long")
    reg = {r.name: r for r in Q.infer_registry(df, "app", id_columns=["SK_ID_CURR"]).collect()}
    assert reg["sk_id_curr"].role == "identifier" and reg["amt_credit"].transform == "log"
    assert reg["name"].encoding == "one_hot" and reg["flag_x"].type == "binary"
    assert reg["cnt_social_circle"].transform == "robust"
    sampled = Q.infer_registry(df, "app", id_columns=["SK_ID_CURR"], sample_rows=50)
    assert sampled.count() == 5


def test_logistic_penalty_is_that_of_a_summed_loss(spark):
    """C weighs the summed loss: same optimum as Newton steps on C·Σ loss + ½|β|²."""
    import numpy as np
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2)) * [1.0, 3.0]
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - 0.4 * x[:, 1])))).astype(float)
    beta, c = np.zeros(3), 0.1
    design = np.column_stack([np.ones(400), x])
    ridge = np.diag([0.0, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        grad = c * design.T @ (p - y) + ridge @ beta
        beta -= np.linalg.solve(c * (design * (p * (1 - p))[:, None]).T @ design + ridge, grad)
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, y double")
    est = TR.model_catalogue(TR.weighted_rows(df), "y", None)["logistic"]
    model = TR.fit_model(df, ["a", "b"], est).stages[-1]
    assert np.allclose([model.intercept, *model.coefficients.toArray()], beta, atol=2e-3)


def test_catalogue_has_the_full_sizes():
    models = TR.model_catalogue(1000.0)
    assert models["random_forest"].getNumTrees() == 150 and models["random_forest"].getMaxDepth() == 10
    assert models["boosting"].getMaxIter() == 100 and models["logistic"].getRegParam() == pytest.approx(0.01)


def test_value_names(spark):
    from credal.operators.profile import value_name
    rows = [("Cash loans", "cash_loans"), ("  XNA / n.a. ", "xna_n_a"), ("2nd  home", "v_2nd_home"), ("--", "unknown"),
            ("", "unknown"), ("Marié(e)", "mari_e")]
    df = spark.createDataFrame(rows, "v string, want string")
    assert [r.got for r in df.select(value_name(F.col("v")).alias("got")).collect()] == [w for _, w in rows]


def test_binary_columns_map_whole_columns_only(spark):
    from credal.functions.clean import map_binary_columns
    df = spark.createDataFrame([("Oui", "F", "Homme", "Y", None), ("Non", "M", "Femme", "maybe", None),
                                (None, "M", None, "N", None)], "a string, b string, c string, d string, e string")
    out = map_binary_columns(df, df.columns).collect()
    assert [r.a for r in out] == [1, 0, None] and [r.c for r in out] == [1, 0, None]
    assert [r.b for r in out] == ["F", "M", "M"] and [r.d for r in out] == ["Y", "maybe", "N"]
    assert [r.e for r in out] == [None] * 3


def test_no_local_scratch_on_a_cluster():
    from credal.session import _local_scratch
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", ""):
        with pytest.raises(RuntimeError):
            _local_scratch(master)
    assert _local_scratch("local[*]")


def test_quantiles_of_infinities(spark):
    from credal.operators.quantiles import exact_quantiles
    inf = float("inf")
    rng = np.random.default_rng(8)
    v = np.concatenate([rng.lognormal(0, 8, 20000), np.full(300, inf), np.full(50, -inf)])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    got = exact_quantiles(df, ["v"], [0.0, 0.001, 0.5, 0.9, 0.99, 1.0])["v"]
    s = np.sort(v)
    at = 0.5 * (len(v) - 1)
    mid = s[int(at)] + (s[int(at) + 1] - s[int(at)]) * (at - int(at))
    assert got[0] == got[1] == -inf and got[4] == got[5] == inf
    assert got[2] == pytest.approx(mid) and got[3] == pytest.approx(np.quantile(v[np.isfinite(v) | (v < 0)], 0.9 * (len(v) - 1) / (20050 - 1)))


def test_many_categories_fit_and_transform(spark):
    n = 30000
    df = spark.range(2 * n).select(F.concat(F.lit("c"), F.col("id") % n).alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    p = P.fit(df, P.PreprocessSpec(target_enc=["c"], target="y"))
    assert p.te_tables and p.feature_names == ["target_enc__c"] and p.sources == {"target_enc__c": "c"}
    p = P.Params.from_json(p.to_json())
    unseen = spark.createDataFrame([("new", 0), (None, 0)], "c string, y int")
    assert [r[0] for r in P.transform(unseen, p).collect()] == [p.te_global] * 2
    got = {r.c: r[1] for r in P.transform(df, p, keep=["c"]).distinct().collect()}
    assert len(got) == n and got["c1"] == pytest.approx((2 * 1.0 + p.te_global) / 3)


def test_index_table_and_factorize(spark):
    from credal.operators.aggregate import index_table
    df = spark.createDataFrame([(f"v{i % 977:04d}" if i % 5 else None,) for i in range(6000)], "v string")
    want = {v: i + 1 for i, v in enumerate(sorted({r.v for r in df.collect() if r.v is not None}))}
    assert {r.v: r["index"] for r in index_table(df, "v").collect()} == want
    got = P.factorize(df.withColumn("w", F.col("v")), ["v"])
    assert all((r.v is None) == (r.w is None) and (r.v is None or r.v == want[r.w] - 1) for r in got.collect())
    assert got.count() == 6000


def test_split_takes_the_ceiling_and_drops_null_labels(spark):
    df = spark.createDataFrame([(i, 0 if i < 8 else 1 if i < 13 else None) for i in range(15)], "id int, y int")
    s = M.stratified_split(df, "y", "id", 0.2)
    assert s.count() == 13 and s.where("split = 'test'").count() == 3


def test_two_value_columns_without_distinct(spark):
    df = spark.createDataFrame([(1, "a", 1.0, None), (2, "b", 1.0, None), (2, "c", None, None)],
                               "two int, three string, one double, none int")
    from credal.operators import profile as PR
    assert PR.two_value_columns(df) == ["two"]


def test_get_x_y_keeps_rows_with_equal_keys(spark):
    df = spark.createDataFrame([(1, 1.0, "1"), (1, 2.0, "0"), (2, 3.0, None)], "k int, x double, y string")
    p = P.fit(df, P.PreprocessSpec(standard=["x"]))
    out = P.get_x_y(df, p, "k", "y")
    assert out.columns == ["k", "standard__x", "y"] and out.count() == 3


def test_correlations_by_blocked_products(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 180)) @ rng.normal(size=(180, 180)) * rng.uniform(1e-3, 1e3, 180) + rng.uniform(-1, 1, 180) * 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 0] = 0.1                                   # one value
    x[:, 1] = np.nan                                # none
    x[2:, 2] = np.nan
    x[1, 2] = x[0, 2]
    pdf = pd.DataFrame(x, columns=[f"c {i}" for i in range(180)])
    df = spark.createDataFrame([tuple(None if math.isnan(v) else float(v) for v in r) for r in x],
                               ", ".join(f"`{c}` double" for c in pdf.columns)).repartition(5)
    pairs = Q.correlation_pairs(df, pdf.columns)
    got = {(r.col_a, r.col_b): r.rho for r in pairs.collect()}
    want = pdf.corr(min_periods=2)
    assert len(got) == 177 * 176 // 2               # the columns without variance have no ρ
    assert all(v == pytest.approx(want.loc[a, b], abs=1e-9) for (a, b), v in got.items())
    assert "corr(" not in pairs._jdf.queryExecution().toString()
    strong = [r.rho for r in Q.correlation_pairs(df, pdf.columns, 0.1).collect()]
    assert strong == pytest.approx(sorted((v for v in got.values() if abs(v) >= 0.1), key=abs, reverse=True))
    assert Q.correlation_pairs(df.limit(0), pdf.columns[:3]).count() == 0
    assert Q.correlation_pairs(df, pdf.columns[:1]).count() == 0


def test_correlation_of_odd_values(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, float("nan"), 3.0), (3.0, 1.0, float("inf")), (4.0, 5.0, 1.0), (5.0, 6.0, 2.5)],
                               "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.rho for r in Q.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert all(math.isnan(v) for v in got.values()) and len(got) == 3
    got = Q.correlation_pairs(df.where("c < 10 or c is null"), ["a", "c"]).first().rho
    assert got == pytest.approx(np.corrcoef([2, 4, 5], [3, 1, 2.5])[0, 1])


def test_several_distinct_counts_without_row_copies(spark):
    rng = np.random.default_rng(5)
    rows = [(None if k == 9 else int(k), f"g{k % 3}", *[None if v == 0 else int(v) for v in r])
            for k, r in zip(rng.integers(0, 10, 500), rng.integers(0, 30, (500, 3)))]
    df = spark.createDataFrame(rows, "k int, g string, a int, b int, c int")
    spec = {"a": ["nunique", "min"], "b": ["nunique"], "c": ["sum", "nunique", "size"]}
    out = A.spec_aggregate(df, ["k", "g"], spec, prefix="x_", extra=[F.max("a").alias("top")])
    want = df.groupBy("k", "g").agg(*A.spec_exprs(spec, "x_"), F.max("a").alias("top"))
    assert out.columns == want.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Expand" in want._jdf.queryExecution().executedPlan().toString()


def test_interpolated_minority_rows(spark):
    rng = np.random.default_rng(4)
    pts = np.round(rng.normal(size=(900, 3)) * [1, 10, 100], 3)
    pts[:40] = pts[0]                                # equal rows
    rows = [(i, int(i < 300), *map(float, p), f"t{i}") for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "id int, y int, a double, b double, c double, tag string").repartition(3)
    out = TR.oversample_interpolated(df, "y", ["id"], ["a", "b", "c"], ratio=1.3)
    got = out.where("synthetic").collect()
    assert len(got) == int(1.3 * 600) - 300 and all(r.y == 1 and r.tag == f"t{r.id}" for r in got)
    assert sorted(map(str, got)) == sorted(map(str, out.where("synthetic").collect()))
    mino = pts[:300]
    for r in got:                                    # on the way from its row to another of the class
        a, s = mino[r.id], np.array([r.a, r.b, r.c])
        step = mino - a
        u = ((s - a) * step).sum(1) / np.maximum((step ** 2).sum(1), 1e-12)
        assert (np.abs(a + np.clip(u, 0, 1)[:, None] * step - s).max(1) < 1e-6).any()
    assert out.where("not synthetic").count() == 900
    plain = TR.oversample_interpolated(df, "y", ["id"], ["a", "b", "c"], ratio=0.1)
    assert plain.count() == 900 and plain.where("synthetic").count() == 0
    one = TR.oversample_interpolated(df.where("id = 0 or y = 0"), "y", ["id"], ["a", "b", "c"], ratio=0.01)
    assert [(r.a, r.b, r.c) for r in one.where("synthetic").collect()] == [tuple(pts[0])] * 5
    gaps = df.where("y = 1").withColumn("a", F.when(F.col("id") % 2 == 0, F.col("a"))).unionByName(df.where("y = 0"))
    assert TR.oversample_interpolated(gaps, "y", ["id"], ["a", "b", "c"], ratio=1.0).where("synthetic").count() == 300


def test_nearest_neighbours_recall(spark):
    from credal.operators.neighbours import nearest_neighbours
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 5))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double, d double, e double")
    got = {r.id: r.near for r in nearest_neighbours(df, "id", list("abcde"), 5).collect()}
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    true = np.argsort(d, axis=1)[:, :5]
    hits = sum(len({n.other for n in got[i]} & set(true[i].tolist())) for i in range(3000))
    assert all(n.distance == pytest.approx(d[i, n.other]) for i in range(0, 3000, 50) for n in got[i])
    assert hits / 15000 >= 0.9
