"""The published threshold curve: its identities hold in the sweep."""

import pytest
from pyspark.sql import functions as F

from credal.operators import evaluate as M

# fixed values: published holdout of 61,503 rows, 4,965 of them positive, 150 thresholds
ROWS, POSITIVES = 61503, 4965
BEST = {"j": 97, "threshold": 0.5383, "fn": 1868, "fp": 17192, "cost": 35872, "f2": 0.3857}
THRESHOLDS = {83: 0.4678, 90: 0.503, 97: 0.5383}


def test_curve_identities_at_the_published_counts(spark):
    """A holdout with the published counts at the best threshold gives its cost and F2."""
    n = F.col("id")
    tp, tn_from = POSITIVES - BEST["fn"], POSITIVES + BEST["fp"]
    df = spark.range(ROWS).select(
        (n < POSITIVES).cast("int").alias("y"),
        F.when(n < tp, 0.54).when(n < POSITIVES, 0.536).when(n < tn_from, 0.54).otherwise(0.536).alias("p"))
    rows = {r.j: r for r in M.threshold_sweep(df, "p", "y", n=150, lo=0.05, hi=0.8).collect()}
    assert len(rows) == 150
    for j, t in THRESHOLDS.items():
        assert round(rows[j].threshold, 4) == t
    best = rows[BEST["j"]]
    assert (best.fn, best.fp, best.cost) == (BEST["fn"], BEST["fp"], BEST["cost"])
    assert best.f2 == pytest.approx(BEST["f2"], abs=5e-5)
    assert best.tp + best.fn == POSITIVES and best.tn + best.fp == ROWS - POSITIVES
    for r in rows.values():
        assert r.cost == 10 * r.fn + r.fp
        assert r.f2 == pytest.approx(5 * r.tp / (5 * r.tp + 4 * r.fn + r.fp) if r.tp else 0.0)
    # 0.536 lies below the best threshold: lower ones take everyone for a default
    assert (rows[90].fn, rows[90].fp) == (0, ROWS - POSITIVES)
    assert M.best_threshold(M.threshold_sweep(df, "p", "y", n=150, lo=0.05, hi=0.8)).first().j == BEST["j"]
