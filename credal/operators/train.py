"""Training, scoring and explanation with Spark ML.

Estimators are the distributed ``pyspark.ml`` ones; class imbalance goes
through ``weightCol`` (M03). An evaluator scores the business cost (10·FN + FP)
at a threshold; grids and out-of-fold scores are in :mod:`credal.operators.folds`.
Scoring is ``model.transform`` over a table or a stream.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credal.functions import clean as C
from credal.operators import evaluate as M
from credal.operators.neighbours import nearest_neighbours

FEATURES = "features"
PROBABILITY = "probability_1"


# M06 --------------------------------------------------------------------------------
def weighted_rows(df: DataFrame, weight: str | None = None) -> float:
    """Σ weights of the training rows (their number without weights)."""
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return float(df.agg(total.alias("n")).first()["n"] or 1)


def model_catalogue(n: float, label: str = "label", weight: str | None = "weight", c: float = 0.1) -> dict:
    """Logistic (C = 0.1, balanced), tree (depth 5, leaf 50), forest (150
    trees, depth 10), boosting (100 rounds, 0.05, depth 4).

    C weighs a summed loss, Spark averages it over the weighted rows ``n``: the
    same optimum has regParam = 1 / (C n), coefficients penalised as they are."""
    common = dict(featuresCol=FEATURES, labelCol=label)
    w = {"weightCol": weight} if weight else {}
    return {
        "logistic": LogisticRegression(regParam=1.0 / (c * n), elasticNetParam=0.0, maxIter=100,
                                       standardization=False, **common, **w),
        "decision_tree": DecisionTreeClassifier(maxDepth=5, minInstancesPerNode=50, **common, **w),
        "random_forest": RandomForestClassifier(numTrees=150, maxDepth=10, seed=42,
                                                **common, **w),
        "boosting": GBTClassifier(maxIter=100, stepSize=0.05, maxDepth=4, seed=42,
                                  **common, **w),
    }


def assemble(features: Sequence[str]) -> VectorAssembler:
    """Vector only at the ML boundary; NULLs must be imputed before."""
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")


def fit_model(df: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    return Pipeline(stages=[assemble(features), estimator]).fit(df)


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = PROBABILITY) -> DataFrame:
    """P(class 1) as a double column (vector → array → element)."""
    return df.withColumn(out, vector_to_array(F.col(prob_col))[1])


class BusinessCostEvaluator(Evaluator):
    """Business cost 10·FN + FP at a probability threshold; lower is better.
    One aggregate job per evaluation."""

    threshold = Param(Params._dummy(), "threshold", "decision threshold", typeConverter=TypeConverters.toFloat)

    def __init__(self, label: str = "label", threshold: float = 0.5, fn_cost: float = M.FN_COST,
                 fp_cost: float = M.FP_COST):
        super().__init__()
        self._setDefault(threshold=0.5)
        self._set(threshold=threshold)
        self.label, self.fn_cost, self.fp_cost = label, fn_cost, fp_cost

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = positive_probability(dataset)
        c = M.confusion_counts(scored, PROBABILITY, self.label, self.getOrDefault(self.threshold)).first()
        return float(self.fn_cost * c["fn"] + self.fp_cost * c["fp"])

    def isLargerBetter(self) -> bool:
        return False


# M04 --------------------------------------------------------------------------------
def oversample_minority(df: DataFrame, label: str, key: Sequence[str], ratio: float = 0.3, minority=1,
                        seed: int = 42) -> DataFrame:
    """M04 (replication baseline): minority rows replicated until the class
    holds ``int(ratio · n_majority)`` rows, exactly. Each minority row is
    repeated ``q`` times plus one more for the ``r`` rows with the smallest
    key hash (``r`` found exactly, see :func:`evaluate.rank_thresholds`).
    Adds ``synthetic`` (false for originals)."""
    counts = M._class_counts(df, label)
    n_min = counts.get(minority, 0)
    n_maj = sum(v for k, v in counts.items() if k != minority)
    extra = int(ratio * n_maj) - n_min
    if extra <= 0 or n_min == 0:
        return df.withColumn("synthetic", F.lit(False))
    q, r = divmod(extra, n_min)
    mino = df.where(F.col(label) == F.lit(minority)).withColumn("__h", M.key_hash(key, seed))
    th = M.rank_thresholds(mino, label, "__h", {minority: [r]})[minority][0] if r > 0 else None
    reps = F.lit(q) + (F.when(F.col("__h") <= F.lit(th), 1).otherwise(0) if th is not None else F.lit(0))
    copies = (mino.withColumn("__k", F.explode(F.sequence(F.lit(1), F.greatest(reps, F.lit(1)))))
              .where(reps >= F.col("__k")).drop("__h", "__k").withColumn("synthetic", F.lit(True)))
    return df.withColumn("synthetic", F.lit(False)).unionByName(copies)


def oversample_interpolated(df: DataFrame, label: str, key: Sequence[str], columns: Sequence[str], ratio: float = 0.3,
                            neighbours: int = 5, minority=1, seed: int = 42) -> DataFrame:
    """Synthetic minority rows until the class holds ``int(ratio · n_majority)``
    rows, exactly. A synthetic row lies between a minority row and one of its
    ``neighbours`` nearest in ``columns`` (:func:`neighbours.nearest_neighbours`),
    neighbour and place drawn by hashes of the key and a running number; rows
    serve in turn, the first by key hash once more. ``columns`` become doubles;
    a value that one of the two lacks is the other's. All other columns, the key
    included, are the minority row's. ``key`` names a row; without a second
    minority row its rows are copies. Adds ``synthetic`` (false for originals)."""
    counts = M._class_counts(df, label)
    n_min = counts.get(minority, 0)
    extra = int(ratio * sum(v for k, v in counts.items() if k != minority)) - n_min
    typed = df.select(*[F.col(f"`{c}`").cast("double").alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])
    if extra <= 0 or n_min == 0:
        return typed.withColumn("synthetic", F.lit(False))
    q, r = divmod(extra, n_min)
    rows = typed.where(F.col(label) == F.lit(minority)).withColumn("__h", M.key_hash(key, seed))
    last = M.rank_thresholds(rows, label, "__h", {minority: [r]})[minority][0] if r else None
    times = F.lit(q) if last is None else F.lit(q) + (F.col("__h") <= F.lit(last)).cast("int")
    near = nearest_neighbours(rows, "__h", columns, neighbours, seed).withColumnRenamed("id", "__id")
    made = rows.where(times > 0).join(near, F.col("__h") == F.col("__id"), "left") \
        .withColumn("__t", F.explode(F.sequence(F.lit(1), times)))
    at = F.pmod(F.xxhash64(F.lit(seed), "__h", "__t", F.lit("neighbour")), F.size("near")) + 1
    place = M.hash_uniform(["__h", "__t"], seed + 1)
    made = made.withColumn("__x", F.when(F.size("near") > 0, F.element_at("near", at.cast("int"))["x"])).withColumn("__u", place)
    between = {}
    for i, c in enumerate(columns):
        a, b = F.col(f"`{c}`"), F.col("__x")[i]
        between[c] = F.coalesce(F.least(F.greatest(a + F.col("__u") * (b - a), F.least(a, b)), F.greatest(a, b)), b, a)
    made = made.select(*[between[c].alias(c) if c in between else F.col(f"`{c}`") for c in df.columns],
                       F.lit(True).alias("synthetic"))
    return typed.withColumn("synthetic", F.lit(False)).unionByName(made)


# M15 --------------------------------------------------------------------------------
def importance_table(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Tree importances or |coefficients|, descending."""
    m = model.stages[-1]
    if hasattr(m, "featureImportances"):
        vals = m.featureImportances.toArray().tolist()
    else:
        vals = [abs(v) for v in m.coefficients.toArray().tolist()]
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    return s.createDataFrame(list(zip(features, map(float, vals))), "feature string, importance double") \
        .orderBy(F.col("importance").desc(), "feature")


# M17 --------------------------------------------------------------------------------
def score(df: DataFrame, model: PipelineModel, threshold: float, keep: Sequence[str] = ()) -> DataFrame:
    """Transform → P(default) → decision; works on batch and streaming."""
    out = positive_probability(model.transform(df))
    return out.select(*keep, F.col(PROBABILITY).alias("probability"),
                      C.decision(F.col(PROBABILITY), threshold).alias("decision"))


# M18 --------------------------------------------------------------------------------
def linear_contributions(df: DataFrame, model: PipelineModel, features: Sequence[str], means: Mapping[str, float],
                         key: str, source_of: Mapping[str, str], top: int = 3) -> tuple[DataFrame, DataFrame]:
    """Exact contributions of a linear model, coef·(x − mean), summed
    back to input columns (``source_of``: output column → input column, as
    ``preprocess.Params.sources`` records it), the ``top``
    sources of every row by |impact| (name breaks ties), and the global mean
    |impact| per source.

    Everything per row is row-local: one Column per source, an array of
    (source, impact) structs sorted inside the row and sliced to ``top`` —
    no shuffle; the global means are one aggregate."""
    coefs = model.stages[-1].coefficients.toArray().tolist()
    by_source: dict[str, Column] = {}
    for f, c in zip(features, coefs):
        term = F.lit(float(c)) * (F.col(f) - F.lit(float(means.get(f, 0.0))))
        src = source_of[f]
        by_source[src] = term if src not in by_source else by_source[src] + term
    names = sorted(by_source)
    per_row = df.select(key, *[by_source[s].alias(f"__src_{i}") for i, s in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(s).alias("source"), F.col(f"__src_{i}").alias("impact"))
                      for i, s in enumerate(names)])
    ranked = F.array_sort(pairs, lambda a, b: F.when(F.abs(a["impact"]) > F.abs(b["impact"]), -1)
                          .when(F.abs(a["impact"]) < F.abs(b["impact"]), 1)
                          .when(a["source"] < b["source"], -1).when(a["source"] > b["source"], 1).otherwise(0))
    top_rows = (per_row.select(key, F.posexplode(F.slice(ranked, 1, top)).alias("pos", "kv"))
                .select(key, "kv.source", "kv.impact", (F.col("pos") + 1).alias("rank"))
                .withColumn("direction", C.direction_label("impact")))
    wide = per_row.agg(*[F.avg(F.abs(F.col(f"__src_{i}"))).alias(f"m{i}") for i in range(len(names))])
    stack = ", ".join(f"'{s}', m{i}" for i, s in enumerate(names))
    global_mean = wide.selectExpr(f"stack({len(names)}, {stack}) AS (source, mean_abs_impact)") \
        .orderBy(F.col("mean_abs_impact").desc(), "source")
    return top_rows, global_mean


def column_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(c).alias(c) for c in features]).first().asDict()
    return {k: (0.0 if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)) for k, v in row.items()}
