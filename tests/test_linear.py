"""A scoring model held as a table: equal to the trained pipeline, edge cases, impacts."""

import math
import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from credal.operators import linear as LM
from credal.operators import train as TR
from credal.sources import io
from credal.streaming import log_stream as S

MODEL = LM.LinearModel(0.5, (LM.Term("a", "a", 2.0, 1.0), LM.Term("b x", "b", -1.0, 0.0), LM.Term("b y", "b", 0.25, 4.0)))


def _rows(spark, n=300, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.gauss(0, 1), rng.random(), rng.gauss(2, 3)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, `b x` double, `b y` double")


def test_table_scores_like_the_trained_pipeline(spark):
    df = _rows(spark).withColumn("label", (F.col("a") + F.col("b x") > 0.4).cast("int"))
    features = ["a", "b x", "b y"]
    fitted = TR.fit_model(df, features, LogisticRegression(featuresCol=TR.FEATURES, labelCol="label", regParam=0.01))
    model = LM.from_pipeline(fitted, features, {"b x": "b", "b y": "b"})
    again = LM.LinearModel.load(spark, model.save(spark, io.scratch_dir(spark, "model")))
    assert again == model
    want = {r.id: r for r in TR.score(df, fitted, 0.5, keep=["id"]).collect()}
    got = LM.score(df, again, 0.5, keep=["id"]).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.probability == pytest.approx(want[r.id].probability, abs=1e-12)
        assert r.decision == want[r.id].decision


def test_scores_are_expressions_without_python_or_shuffle(spark):
    plan = LM.score(_rows(spark), MODEL, 0.5, keep=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_nulls_nan_empty_tables_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, None, 1.0, 1.0), (2, float("nan"), 1.0, 1.0), (3, 0.0, 0.0, 0.0), (3, 0.0, 0.0, 0.0)],
                               "id long, a double, `b x` double, `b y` double")
    got = sorted(LM.score(df, MODEL, 0.5, keep=["id"]).collect(), key=lambda r: r.id)
    assert [(r.probability, r.decision) for r in got[:2]] == [(None, None), (None, None)]
    assert [r.probability for r in got[2:]] == [pytest.approx(1 / (1 + math.exp(-0.5)))] * 2
    assert LM.score(df.limit(0), MODEL, 0.5, keep=["id"]).count() == 0
    assert LM.top_impacts(df.limit(0), MODEL, ["id"]).count() == 0
    assert [r.mean_abs_impact for r in LM.mean_impacts(df.limit(0), MODEL).collect()] == [None, None]


def test_model_without_features_and_table_without_intercept(spark):
    only = LM.LinearModel(0.0, ())
    assert LM.LinearModel.from_dataframe(only.to_dataframe(spark)) == only
    assert {r.probability for r in LM.score(_rows(spark, 5), only, 0.5).collect()} == {0.5}
    with pytest.raises(ValueError, match="one intercept"):
        LM.LinearModel.from_dataframe(MODEL.to_dataframe(spark).where("feature IS NOT NULL"))


def test_impacts_against_brute_force(spark):
    df = _rows(spark, 50)
    want = {}
    for r in df.collect():
        impacts = {"a": 2.0 * (r["a"] - 1.0), "b": -r["b x"] + 0.25 * (r["b y"] - 4.0)}
        want[r.id] = sorted(impacts.items(), key=lambda kv: (-abs(kv[1]), kv[0]))
    got = LM.top_impacts(df, MODEL, ["id"], top=2).collect()
    assert len(got) == 100
    for r in got:
        source, impact = want[r.id][r["rank"] - 1]
        assert r.source == source and r.impact == pytest.approx(impact, abs=1e-12)
    means = {r.source: r.mean_abs_impact for r in LM.mean_impacts(df, MODEL).collect()}
    for source in ("a", "b"):
        assert means[source] == pytest.approx(sum(abs(dict(v)[source]) for v in want.values()) / 50)


def test_ties_go_to_the_smaller_name(spark):
    model = LM.LinearModel(0.0, (LM.Term("b y", "z", 1.0), LM.Term("a", "m", -1.0)))
    df = spark.createDataFrame([(1, 3.0, 0.0, 3.0)], "id long, a double, `b x` double, `b y` double")
    got = sorted(LM.top_impacts(df, model, ["id"]).collect(), key=lambda r: r["rank"])
    assert [(r.source, r.impact) for r in got] == [("m", -3.0), ("z", 3.0)]


def test_exact_window_percentiles_go_on_from_the_checkpoint(spark):
    """Closed windows are whole, equal numpy's percentiles, and a second run over
    later rows adds windows without touching the first ones."""
    import numpy as np
    rng = random.Random(9)
    base = io.scratch_dir(spark, "window-percentiles")
    kept = {}

    def append(days):
        rows = []
        for day in days:
            for _ in range(200):
                v = rng.choice([None, round(rng.expovariate(0.1), 1)])
                rows.append((f"2024-03-{day:02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00", v))
                if v is not None:
                    kept.setdefault(day, []).append(v)
        io.append_jsonl(spark.createDataFrame(rows, "ts string, latency_ms double")
                        .withColumn("ts", F.col("ts").cast("timestamp_ntz")), f"{base}/log")

    schema = spark.createDataFrame([], "ts timestamp_ntz, latency_ms double").schema
    seen = []
    for days in ((1, 2, 3), (4, 5)):
        append(days)
        counts = S.windowed_value_counts(S.read_log_stream(spark, f"{base}/log", schema), "latency_ms")
        S.run_to_table(counts.select(F.dayofmonth("w.start").alias("day"), "latency_ms", "n"), f"{base}/out", f"{base}/ckpt")
        out = S.closed_window_percentiles(spark.read.parquet(f"{base}/out"), "day", "latency_ms", [0.5, 0.95])
        seen.append({r.day: (r.p50, r.p95) for r in out.collect()})
    assert set(seen[0]) == {1, 2} and set(seen[1]) == {1, 2, 3, 4}
    assert all(seen[1][d] == seen[0][d] for d in seen[0])
    for day, found in seen[1].items():
        assert found == pytest.approx(tuple(np.percentile(kept[day], [50, 95])))
