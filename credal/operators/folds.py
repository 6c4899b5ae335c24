"""Encoders fitted inside folds, and cross-validation over several models.

An encoder that saw a row's label leaks it into the row's features, most of all
the smoothed target encoding. Here the preprocessor is an ML ``Estimator``: as a
stage of a ``Pipeline`` it is refitted wherever the pipeline is.

A search over many candidates doesn't refit it for each of them: a fold's
encoders depend on the fold alone. :func:`fold_matrices` fits them once per fold
on the other folds' rows and writes that fold's matrix, labels and weights to
the shared folder; all candidates of all models read it. All of a fold's fitted
candidates are scored by one pass over its rows for the trees and one for the
others, so a candidate costs its fit and no job beside it, and a tree that is
the first levels of a deeper one not even a fit.
"""

from __future__ import annotations

import itertools
import math
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credal.operators import evaluate as M
from credal.operators import preprocess as P
from credal.operators import train as TR
from credal.session import checkpoint_path, written

WEIGHT = "weight"


# E20 as ML stages ---------------------------------------------------------------------
class Preprocessor(Estimator):
    """:func:`preprocess.fit` as a stage: learns on the rows it is given."""

    def __init__(self, spec: P.PreprocessSpec, features: str = TR.FEATURES):
        super().__init__()
        self.spec, self.features = spec, features

    def _fit(self, dataset: DataFrame) -> PreprocessorModel:
        return PreprocessorModel(P.fit(dataset, self.spec), self.features)


class PreprocessorModel(Model):
    """:func:`preprocess.transform`: the input's columns and the feature vector."""

    def __init__(self, fitted: P.Params, features: str = TR.FEATURES):
        super().__init__()
        self.fitted, self.features = fitted, features

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.fitted.feature_names
        wide = P.transform(dataset, self.fitted, keep=dataset.columns)
        vector = VectorAssembler(inputCols=names, outputCol=self.features, handleInvalid="keep")
        return vector.transform(wide).select(*dataset.columns, self.features)


# folds --------------------------------------------------------------------------------
@dataclass
class Fold:
    """A fold's matrix, written: ``key``, label, fold, weight and features of all
    rows, encoded and weighted by the rows of the other folds."""
    number: int
    matrix: DataFrame
    encoders: PreprocessorModel
    n_train: int
    fold_col: str

    @property
    def train(self) -> DataFrame:
        return self.matrix.where(F.col(self.fold_col) != self.number)

    @property
    def held_out(self) -> DataFrame:
        return self.matrix.where(F.col(self.fold_col) == self.number)

    @property
    def outside(self) -> DataFrame:
        """Rows of no fold: a test population."""
        return self.matrix.where(F.col(self.fold_col).isNull())


def fold_matrices(df: DataFrame, spec: P.PreprocessSpec, label: str, key: Sequence[str], fold_col: str,
                  balanced: bool = True) -> list[Fold]:
    """One :class:`Fold` per value of ``fold_col``. Encoders and class weights of a
    fold never see its rows, nor rows without a fold; those are encoded, too."""
    sizes = df.where(F.col(fold_col).isNotNull()).groupBy(fold_col, label).count().collect()    # folds x classes
    out = []
    for f in sorted({r[fold_col] for r in sizes}):
        counts: dict = {}
        for r in sizes:
            if r[fold_col] != f:
                counts[r[label]] = counts.get(r[label], 0) + r["count"]
        n = sum(counts.values())
        weights = {c: n / (len(counts) * m) for c, m in counts.items()} if balanced else {}
        encoders = Preprocessor(spec).fit(df.where(F.col(fold_col) != f))
        matrix = encoders.transform(df).select(*key, label, fold_col, TR.FEATURES)
        matrix = M.with_class_weight(matrix, label, weights, WEIGHT) if weights else matrix.withColumn(WEIGHT, F.lit(1.0))
        out.append(Fold(f, written(matrix, f"fold-{f}"), encoders, n, fold_col))
    return out


# M07 ----------------------------------------------------------------------------------
# The candidates of each model's grid.
GRIDS: dict[str, dict[str, list]] = {
    "logistic": {"C": [0.01, 0.1, 1.0, 10.0], "solver": ["lbfgs", "liblinear"], "max_iter": [500, 1000]},
    "decision_tree": {"max_depth": [3, 5, 8, 12], "min_samples_leaf": [20, 50, 100], "min_samples_split": [30, 50]},
    "random_forest": {"n_estimators": [100, 200], "max_depth": [8, 12, 16], "max_features": ["sqrt", "log2"]},
    "boosting": {"n_estimators": [100, 200], "learning_rate": [0.03, 0.05, 0.10], "max_depth": [3, 4, 5]},
}


@dataclass(frozen=True)
class Candidate:
    model: str
    params: tuple[tuple[str, object], ...]

    @property
    def text(self) -> str:
        return ", ".join(f"{k}={v}" for k, v in self.params)

    def settings(self, n: int) -> dict[str, object]:
        """The Spark parameters for ``n`` training rows.

        ``C`` weighs a summed loss, Spark averages: regParam = 1 / (C n). Both
        solvers have one optimum, Spark's. A node of fewer than
        ``min_samples_split`` rows doesn't split; Spark has a limit for children
        only, which half of it implies."""
        p = dict(self.params)
        if self.model == "logistic":
            return {"regParam": 1.0 / (p["C"] * n), "maxIter": p["max_iter"]}
        if self.model == "decision_tree":
            return {"maxDepth": p["max_depth"],
                    "minInstancesPerNode": max(p["min_samples_leaf"], math.ceil(p["min_samples_split"] / 2))}
        if self.model == "random_forest":
            return {"numTrees": p["n_estimators"], "maxDepth": p["max_depth"], "featureSubsetStrategy": p["max_features"]}
        return {"maxIter": p["n_estimators"], "stepSize": p["learning_rate"], "maxDepth": p["max_depth"]}


def candidates(model: str, grid: Mapping[str, Sequence] | None = None) -> list[Candidate]:
    """All combinations of a model's grid, in the order of its lists."""
    grid = grid or GRIDS[model]
    return [Candidate(model, tuple(zip(grid, values))) for values in itertools.product(*grid.values())]


def estimator(model: str, settings: Mapping[str, object], n: int, label: str) -> Estimator:
    """The catalogue's estimator of the name with the settings; boosting unweighted."""
    base = TR.model_catalogue(n, label, None if model == "boosting" else WEIGHT)[model].copy()
    if model == "decision_tree" or model == "random_forest":
        base.set(base.minInstancesPerNode, 1)
    for name, value in settings.items():
        base.set(base.getParam(name), value)
    return base


def _distinct(found: Sequence[Candidate], n: int) -> dict[tuple, list[Candidate]]:
    """Candidates by their Spark settings: equal ones are fitted once."""
    out: dict[tuple, list[Candidate]] = {}
    for c in found:
        out.setdefault((c.model, tuple(sorted(c.settings(n).items()))), []).append(c)
    return out


@dataclass(frozen=True)
class Node:
    """A node of a fitted tree; ``left`` and ``right`` are places in its table, None in a leaf."""
    prediction: float
    stats: tuple[float, ...]
    left: int | None
    right: int | None


def tree_nodes(spark: SparkSession, model: Model) -> list[Node]:
    """The nodes of a fitted decision tree in the order of their numbers, a node before
    its left and these before its right ones; so the leaves are in the order of ``leafCol``."""
    path = checkpoint_path(spark, f"tree-{uuid.uuid4().hex[:12]}")
    model.write().save(path)
    rows = sorted(spark.read.parquet(f"{path}/data").select("id", "prediction", "impurityStats", "leftChild", "rightChild")
                  .collect(), key=lambda r: r.id)                      # 2 ** (depth + 1) rows at most
    place = {r.id: i for i, r in enumerate(rows)}
    return [Node(r.prediction, tuple(r.impurityStats), *((place[r.leftChild], place[r.rightChild])
                                                         if r.leftChild >= 0 else (None, None))) for r in rows]


def first_levels(nodes: Sequence[Node], depth: int) -> list[tuple[float, ...]]:
    """For each leaf of a tree, the class weights of the leaf that holds its rows in the
    same tree fitted to ``depth`` levels only. Levels are fitted one after another, so that
    tree has the same nodes down to its last level, and leaves of one prediction below one
    node are merged there, too."""
    out: list[tuple[float, ...]] = []

    def leaf(at: int, level: int) -> bool:
        """Adds the leaves below a node; is it a leaf of the smaller tree?"""
        node, begin = nodes[at], len(out)
        if node.left is None:
            out.append(node.stats)
            return True
        ends = leaf(node.left, level + 1), leaf(node.right, level + 1)
        one = level >= depth or all(ends) and nodes[node.left].prediction == nodes[node.right].prediction
        if one:
            out[begin:] = [node.stats] * (len(out) - begin)
        return one

    leaf(0, 0)
    return out


def fits_at_once(spark: SparkSession, rows: int, features: int, most: int) -> tuple[int, bool]:
    """How many fits over ``rows`` run beside each other, and whether their rows are
    kept beside them: each fit keeps the rows in a layout of its own, and what the
    executors' storage can't hold goes to disk and back at every step."""
    try:
        status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus()
        sizes = [status.apply(k)._1() for k in _each(status.keys())]
        driver = 0 if re.match(r"local(\[|$)", spark.sparkContext.master) else 1
        storage = sum(sorted(sizes)[::-1][: max(1, len(sizes) - driver)])
    except Exception:  # a remote (Spark Connect) session doesn't tell
        return most, True
    one = rows * (8 * features + 64)
    return max(1, min(most, storage // max(1, one) - 1)), 2 * one <= storage


def _each(found):
    it = found.iterator()
    while it.hasNext():
        yield it.next()


def fold_counts(fold: Fold, found: Sequence[Candidate], label: str, threshold: float, parallelism: int) -> list[tuple]:
    """(candidate, fold, tn, fp, fn, tp) of every candidate, fitted without the
    fold's rows and scored on them; one aggregate for all trees, one for all others.

    A decision tree is fitted to the greatest of the depths that are asked for with
    its other settings; the others are its first levels (:func:`first_levels`)."""
    groups = _distinct(found, fold.n_train)
    train = fold.train.select(TR.FEATURES, label, WEIGHT)
    spark = train.sparkSession
    at_once, kept = fits_at_once(spark, fold.n_train, len(fold.encoders.fitted.feature_names), parallelism)
    if kept:
        train = train.persist()
    families: dict[tuple, list[tuple]] = {}
    for key in groups:
        # only the logistic model's limit leaves the steps before it as they are, and a tree's depth its levels
        free = {"logistic": "maxIter", "decision_tree": "maxDepth"}.get(key[0])
        families.setdefault((key[0], tuple(kv for kv in key[1] if kv[0] != free)), []).append(key)
    try:
        def fit(keys):
            """Models of settings that differ in ``maxIter`` only, the largest first: a
            model that stopped before a smaller limit is that limit's model, too. Of
            trees that differ in depth the deepest, and its nodes."""
            if keys[0][0] == "decision_tree":
                deepest = max(keys, key=lambda key: dict(key[1])["maxDepth"])
                model = estimator(deepest[0], dict(deepest[1]), fold.n_train, label).fit(train)
                return model, tree_nodes(spark, model)
            out = {}
            for key in sorted(keys, key=lambda key: -dict(key[1]).get("maxIter", 0)):
                done = next((m for m in out.values() if key[0] == "logistic"
                             and m.summary.totalIterations < dict(key[1])["maxIter"]), None)
                out[key] = done or estimator(key[0], dict(key[1]), fold.n_train, label).fit(train)
            return out

        with ThreadPool(at_once) as pool:
            fitted = pool.map(inheritable_thread_target(spark)(fit), list(families.values()), chunksize=1)
    finally:
        if kept:
            train.unpersist()
    counts = _tree_counts(fold, label, threshold, [(keys, *got) for keys, got in zip(families.values(), fitted)
                                                   if keys[0][0] == "decision_tree"])
    counts |= _model_counts(fold, label, threshold, {key: model for keys, got in zip(families.values(), fitted)
                                                     if keys[0][0] != "decision_tree" for key, model in got.items()})
    return [(c, fold.number, *counts[key]) for key, same in groups.items() for c in same]


def _model_counts(fold: Fold, label: str, threshold: float, models: Mapping[tuple, Model]) -> dict[tuple, tuple]:
    """tn, fp, fn, tp of each model on the fold's rows."""
    if not models:
        return {}
    scored = fold.held_out.select(TR.FEATURES, label)
    for i, model in enumerate(models.values()):
        scored = model.setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"__p{i}").transform(scored)
    y = F.col(label) == 1
    aggs: list[Column] = []
    for i in range(len(models)):
        hit = vector_to_array(F.col(f"__p{i}"))[1] >= threshold
        aggs += [F.count_if(~hit & ~y).alias(f"tn{i}"), F.count_if(hit & ~y).alias(f"fp{i}"),
                 F.count_if(~hit & y).alias(f"fn{i}"), F.count_if(hit & y).alias(f"tp{i}")]
    row = scored.agg(*aggs).first()
    return {key: tuple(row[f"{k}{i}"] for k in ("tn", "fp", "fn", "tp")) for i, key in enumerate(models)}


def _tree_counts(fold: Fold, label: str, threshold: float, trees: Sequence[tuple]) -> dict[tuple, tuple]:
    """tn, fp, fn, tp of each setting on the fold's rows; ``trees``: settings that differ
    in depth, the deepest's model and nodes. Rows are counted by leaf and label."""
    if not trees:
        return {}
    rows = fold.held_out.select(TR.FEATURES, label).where(F.col(label).isNotNull())
    for i, (_, model, _) in enumerate(trees):
        rows = model.setRawPredictionCol("").setPredictionCol("").setProbabilityCol("").setLeafCol(f"__l{i}").transform(rows)
    found = rows.select((F.col(label) == 1).alias("y"),
                        F.posexplode(F.array(*[F.col(f"__l{i}").cast("int") for i in range(len(trees))])).alias("tree", "leaf")) \
        .groupBy("tree", "leaf", "y").count().collect()                # trees x leaves x 2
    out = {}
    for i, (keys, _, nodes) in enumerate(trees):
        for key in keys:
            hits = [stats[1] / sum(stats) >= threshold for stats in first_levels(nodes, dict(key[1])["maxDepth"])]
            total = {(y, hit): 0 for y in (False, True) for hit in (False, True)}
            for r in found:
                if r["tree"] == i:
                    total[r["y"], hits[r["leaf"]]] += r["count"]
            out[key] = total[False, False], total[False, True], total[True, False], total[True, True]
    return out


@dataclass
class Search:
    """Result of a search. ``folds``: model, params, fold and confusion counts;
    ``table``: mean cost, its deviation and rank per candidate; ``best``: the
    candidate of least mean cost, the first in order among equals."""
    folds: DataFrame
    table: DataFrame
    best: Candidate


def grid_search(df: DataFrame, spec: P.PreprocessSpec, label: str, key: Sequence[str], fold_col: str,
                models: Sequence[str] = tuple(GRIDS), grids: Mapping[str, Mapping[str, Sequence]] | None = None,
                threshold: float = 0.5, parallelism: int = 4) -> Search:
    """Every candidate of every model over all folds, scored by the business
    cost ``10 FN + FP``. All models share each fold's stored matrix."""
    found = [c for m in models for c in candidates(m, (grids or {}).get(m))]
    rows = [r for fold in fold_matrices(df, spec, label, key, fold_col)
            for r in fold_counts(fold, found, label, threshold, parallelism)]
    place = {c: i for i, c in enumerate(found)}
    folds = df.sparkSession.createDataFrame(
        [(place[c], c.model, c.text, int(f), *map(int, counts)) for c, f, *counts in rows],
        "candidate int, model string, params string, fold int, tn long, fp long, fn long, tp long")
    folds = folds.withColumn("cost", F.lit(float(M.FN_COST)) * F.col("fn") + F.lit(float(M.FP_COST)) * F.col("fp"))
    table = folds.groupBy("candidate", "model", "params").agg(
        F.avg("cost").alias("mean_cv_cost"), F.stddev_pop("cost").alias("std_cv_cost"),
        F.sum("tn").alias("tn"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.sum("tp").alias("tp"))
    first = table.orderBy("mean_cv_cost", "candidate").first()
    return Search(folds, table, found[first["candidate"]])


def refit(df: DataFrame, spec: P.PreprocessSpec, label: str, best: Candidate) -> PipelineModel:
    """Encoders and the best candidate fitted on all labelled rows."""
    rows = df.where(F.col(label).isNotNull())
    weights = M.class_weights(rows, label)
    n = rows.count()
    weighted = M.with_class_weight(rows, label, weights, WEIGHT)
    return Pipeline(stages=[Preprocessor(spec), estimator(best.model, best.settings(n), n, label)]).fit(weighted)


# M16 ----------------------------------------------------------------------------------
def out_of_fold(df: DataFrame, spec: P.PreprocessSpec, label: str, key: Sequence[str], fold_col: str,
                make: Callable[[int], Estimator]) -> tuple[DataFrame, DataFrame, list[Fold]]:
    """(scores of the rows with a fold, each by encoders and a model that
    never saw its fold; mean score of the rows without one over all folds'
    models; the folds). ``make(n)`` gives the estimator for ``n`` training rows."""
    folds = fold_matrices(df, spec, label, key, fold_col)
    inside, outside = [], []
    for fold in folds:
        model = make(fold.n_train).fit(fold.train)
        score = TR.positive_probability(model.transform(fold.matrix.where(
            F.col(fold_col).isNull() | (F.col(fold_col) == fold.number))))
        score = score.select(*key, fold_col, TR.PROBABILITY)
        inside.append(score.where(F.col(fold_col).isNotNull()))
        outside.append(score.where(F.col(fold_col).isNull()))
    test = reduce(DataFrame.unionByName, outside).groupBy(*key).agg(F.avg(TR.PROBABILITY).alias(TR.PROBABILITY))
    return reduce(DataFrame.unionByName, inside), test, folds
