"""Encoders inside folds, grids of several models, out-of-fold scores."""

import random
from itertools import product

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from credal.operators import folds as FO
from credal.operators import preprocess as P
from credal.operators import train as TR

SPEC = P.PreprocessSpec(standard=["a"], target_enc=["c"], one_hot=["o"], target="y")


def some_rows(seed=1, n=300):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        c = rng.choice("pqrstuv")
        y = int(rng.random() < (0.2 if c in "pqr" else 0.6))
        out.append((k, rng.choice([None, rng.random(), y + rng.random()]), c, rng.choice(["x", None]), y, k % 5))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(some_rows() + [(1000 + k, 0.5, c, "x", 0, None) for k, c in enumerate("pqz")],
                                 "id long, a double, c string, o string, y int, fold int").persist()


def features(fold):
    return {r.id: r.v for r in fold.matrix.select("id", vector_to_array("features").alias("v")).collect()}


def test_a_folds_encoders_do_not_see_its_labels(spark, rows):
    base = FO.fold_matrices(rows, SPEC, "y", ["id"], "fold")
    assert [f.number for f in base] == [0, 1, 2, 3, 4] and [f.n_train for f in base] == [240] * 5
    flipped = rows.withColumn("y", F.when(F.col("fold") == 2, 1 - F.col("y")).otherwise(F.col("y")))
    other = FO.fold_matrices(flipped, SPEC, "y", ["id"], "fold")
    for a, b in zip(base, other):
        assert (features(a) == features(b)) == (a.number == 2)
    # the encoders are those of a fit on the other folds' rows, and rows without a fold shape none
    want = P.fit(rows.where("fold <> 3"), SPEC)
    got = base[3].encoders.fitted
    assert (got.te_maps, got.means, got.categories) == (want.te_maps, want.means, want.categories)
    assert rows.where("fold <> 3").count() == 240
    weights = {(r.y, r.weight) for r in base[3].train.select("y", "weight").distinct().collect()}
    n1 = base[3].train.where("y = 1").count()
    assert weights == {(1, 240 / (2 * n1)), (0, 240 / (2 * (240 - n1)))}
    assert sorted(r.id for r in base[3].outside.collect()) == [1000, 1001, 1002]


def test_grids_have_all_candidates():
    want = {"logistic": 16, "decision_tree": 24, "random_forest": 12, "boosting": 18}
    assert {m: len(FO.candidates(m)) for m in FO.GRIDS} == want
    tree = FO.candidates("decision_tree")
    assert [dict(c.params) for c in tree][:2] == [{"max_depth": 3, "min_samples_leaf": 20, "min_samples_split": s} for s in (30, 50)]
    assert {c.settings(10)["minInstancesPerNode"] for c in tree} == {20, 25, 50, 100}
    assert [c.settings(200)["regParam"] for c in FO.candidates("logistic")][::4] == [1 / (c * 200) for c in (0.01, 0.1, 1.0, 10.0)]
    for m, grid in FO.GRIDS.items():
        assert len({c.params for c in FO.candidates(m)}) == len(list(product(*grid.values())))


def test_grid_search_costs_equal_single_fits(spark, rows):
    grids = {"logistic": {"C": [0.01, 1.0], "solver": ["lbfgs", "liblinear"], "max_iter": [50]},
             "decision_tree": {"max_depth": [1, 3], "min_samples_leaf": [5], "min_samples_split": [10]},
             "random_forest": {"n_estimators": [3], "max_depth": [2], "max_features": ["sqrt"]},
             "boosting": {"n_estimators": [2], "learning_rate": [0.1], "max_depth": [2]}}
    got = FO.grid_search(rows, SPEC, "y", ["id"], "fold", grids=grids)
    per_fold = {(r.model, r.params, r.fold): (r.tn, r.fp, r.fn, r.tp) for r in got.folds.collect()}
    assert len(per_fold) == 5 * 8 and all(sum(v) == 60 for v in per_fold.values())
    folds = FO.fold_matrices(rows, SPEC, "y", ["id"], "fold")
    for c in [FO.candidates("logistic", grids["logistic"])[2], FO.candidates("decision_tree", grids["decision_tree"])[1]]:
        for fold in folds[:2]:
            model = FO.estimator(c.model, c.settings(240), 240, "y").fit(fold.train)
            scored = model.transform(fold.held_out).select("y", vector_to_array("probability")[1].alias("p")).collect()
            count = [sum((r.p >= 0.5) == h and r.y == y for r in scored) for h, y in ((False, 0), (True, 0), (False, 1), (True, 1))]
            assert per_fold[c.model, c.text, fold.number] == tuple(count)
    table = {(r.model, r.params): r for r in got.table.collect()}
    for (model, params), r in table.items():
        costs = [10 * fn + fp for (m, p, _), (_, fp, fn, _) in per_fold.items() if (m, p) == (model, params)]
        assert r.mean_cv_cost == pytest.approx(sum(costs) / 5)
    # both solvers are one fit; the first of equals is the best
    assert table["logistic", "C=0.01, solver=lbfgs, max_iter=50"].mean_cv_cost == \
        table["logistic", "C=0.01, solver=liblinear, max_iter=50"].mean_cv_cost
    least = min(r.mean_cv_cost for r in table.values())
    assert got.best == next(c for m in grids for c in FO.candidates(m, grids[m]) if table[m, c.text].mean_cv_cost == least)
    final = FO.refit(rows, SPEC, "y", got.best)
    assert final.transform(rows).count() == 303 and final.stages[0].fitted.te_maps == P.fit(rows, SPEC).te_maps


def test_a_shallower_tree_is_the_first_levels_of_a_deeper_one(spark, monkeypatch):
    """Counts of every depth equal those of a fit of its own, and only the deepest is fitted."""
    rng = random.Random(7)
    data = [(k, rng.random(), rng.choice("pqrstuvw"), rng.choice(["x", None]), k % 5) for k in range(4000)]
    df = spark.createDataFrame([(k, a, c, o, int(rng.random() < 0.3 + 0.4 * (a > 0.5) * (c < "s") + 0.2 * (0.2 < a < 0.4)), f)
                                for k, a, c, o, f in data], "id long, a double, c string, o string, y int, fold int")
    grid = {"decision_tree": {"max_depth": [1, 2, 3, 5, 8], "min_samples_leaf": [5, 40], "min_samples_split": [2]}}
    found = FO.candidates("decision_tree", grid["decision_tree"])
    fold = FO.fold_matrices(df, SPEC, "y", ["id"], "fold")[1]
    fits, single = [], {}
    for c in found:
        model = FO.estimator(c.model, c.settings(fold.n_train), fold.n_train, "y").fit(fold.train)
        scored = model.transform(fold.held_out).select("y", vector_to_array("probability")[1].alias("p")).collect()
        single[c] = tuple(sum((r.p >= 0.5) == h and r.y == y for r in scored) for y, h in ((0, False), (0, True), (1, False), (1, True)))
    make = FO.estimator
    monkeypatch.setattr(FO, "estimator", lambda *a: fits.append(a[1]["maxDepth"]) or make(*a))
    got = {c: tuple(counts) for c, _, *counts in FO.fold_counts(fold, found, "y", 0.5, 2)}
    assert got == single and len(set(got.values())) > 3
    assert fits == [8, 8]


def test_fits_beside_each_other_fit_into_the_storage(spark):
    assert FO.fits_at_once(spark, 10_000, 12, 4) == (4, True)
    assert FO.fits_at_once(spark, 10 ** 12, 12, 4) == (1, False)


def test_out_of_fold_scores(spark, rows):
    make = lambda n: TR.model_catalogue(n, "y", FO.WEIGHT)["logistic"]
    oof, test, folds = FO.out_of_fold(rows, SPEC, "y", ["id"], "fold", make)
    got = {r.id: r.probability_1 for r in oof.collect()}
    assert sorted(got) == list(range(300))
    one = TR.positive_probability(make(240).fit(folds[4].train).transform(folds[4].held_out)).collect()
    assert all(abs(got[r.id] - r.probability_1) < 1e-9 for r in one)
    means = {r.id: r.probability_1 for r in test.collect()}
    each = [TR.positive_probability(make(240).fit(f.train).transform(f.outside)).collect() for f in folds]
    for i in (1000, 1001, 1002):
        assert means[i] == pytest.approx(sum(r.probability_1 for part in each for r in part if r.id == i) / 5)


def test_preprocessor_is_a_pipeline_stage(spark, rows):
    """A CrossValidator refits the encoders with the model in each fold."""
    est = TR.model_catalogue(240, "y", None)["logistic"]
    seen = []
    class Watched(FO.Preprocessor):
        def _fit(self, dataset):
            seen.append(sorted(r.fold for r in dataset.select("fold").distinct().collect()))
            return super()._fit(dataset)
    labelled = rows.where("fold is not null")
    cv = CrossValidator(estimator=Pipeline(stages=[Watched(SPEC), est]), foldCol="fold", numFolds=5,
                        estimatorParamMaps=ParamGridBuilder().addGrid(est.regParam, [0.1]).build(),
                        evaluator=TR.BusinessCostEvaluator("y"))
    assert cv.fit(labelled).avgMetrics[0] > 0
    assert sorted(seen) == sorted([[x for x in range(5) if x != f] for f in range(5)] + [list(range(5))])


def test_ordinal_of_many_values_is_a_table(spark):
    n = 300_000
    df = spark.range(n).select(F.concat(F.lit("v"), (F.col("id") * 7919 % n).cast("string")).alias("c"))
    p = P.fit(df, P.PreprocessSpec(ordinal=["c"]))
    assert not p.ordinal_categories and p.feature_names == ["ordinal__c"]
    p = P.Params.from_json(p.to_json())
    out = P.transform(df.union(spark.createDataFrame([("new",), (None,)], "c string")), p, keep=["c"])
    order = {v: i for i, v in enumerate(sorted(f"v{k}" for k in range(n)))}
    got = out.collect()
    assert len(got) == n + 2 and all(r.ordinal__c == order.get(r.c, -1) for r in got)
