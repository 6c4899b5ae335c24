"""Matrix → champion model and decision threshold (the second entry point).

exact stratified split (M01) → class weights (M03) → every catalogue model
fitted on train, scored on eval (M06, M11) → comparison ranked by F2 with the
champion flagged (M13, W01) → 150-threshold sweep of the champion's eval
scores at cost 10·FN + FP, lowest cost first on ties (M09) → refit of the
champion on train ∪ eval (M14).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.operators import evaluate as M
from credal.operators import train as TR
from credal.session import dealt, written


def champion_and_threshold(matrix: DataFrame, features: Sequence[str], label: str, key: Sequence[str],
                           models: Sequence[str] = ("logistic", "decision_tree", "random_forest", "boosting"), eval_fraction: float = 0.2,
                           n_thresholds: int = 150, seed: int = 42):
    """Returns (comparison table, threshold curve of the champion, refitted champion)."""
    split = M.stratified_split(matrix, label, key, eval_fraction, seed=seed)
    weights = M.class_weights(split.where(F.col("split") == "train"), label)
    # fits and scores scan the rows again and again: they are computed and dealt to the cores once
    split = dealt(written(M.with_class_weight(split, label, weights), "labelled"), "labelled-parts")
    train, ev = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    catalogue = TR.model_catalogue(TR.weighted_rows(train, "weight"), label, "weight")
    rows, scored_by_model = None, {}
    for name in models:
        model = TR.fit_model(train, features, catalogue[name])
        scored = TR.positive_probability(model.transform(ev)).select(label, TR.PROBABILITY)
        scored = written(scored, "scored")
        scored_by_model[name] = scored
        r = M.metrics_from_counts(M.confusion_counts(scored, TR.PROBABILITY, label, 0.5)).select(
            F.lit(name).alias("model"), "f1", "f2", "recall", "precision", "cost")
        rows = r if rows is None else rows.unionByName(r)
    comparison = M.rank_models(rows, "f2")
    champion = comparison.where("champion").select("model").first()["model"]
    curve = M.threshold_sweep(scored_by_model[champion], TR.PROBABILITY, label, n=n_thresholds) \
        .withColumn("model", F.lit(champion))
    every = train.unionByName(ev)
    final = TR.fit_model(every, features, TR.model_catalogue(TR.weighted_rows(every, "weight"), label, "weight")[champion])
    return comparison, curve, final
