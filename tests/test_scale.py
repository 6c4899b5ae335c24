"""Steps that are repeated over the whole input do their work once, and in parallel."""

import math
import random

from pyspark.sql import functions as F


def test_wide_rows_are_joined_once(spark):
    from credal.plans import demo_preprocess as D
    plan = D.q_wide(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 1        # the target encoding, if it is a table
    assert D.wide_matrix(spark, "/root/testdata/sf0.001").count() == D.table(spark, "/root/testdata/sf0.001", "lineitem").count()


def test_a_curve_gives_a_row_per_row():
    import numpy as np
    import pyarrow as pa

    from credal.operators.neighbours import _nearest
    rng = np.random.default_rng(1)
    x = rng.random((500, 3))
    ids = np.arange(500) // 2 * 2          # rows that share an id are not neighbours
    parts = [pa.RecordBatch.from_arrays([pa.array(ids[a:a + 60]), pa.array(list(x[a:a + 60]), pa.list_(pa.float64()))], ["id", "x"])
             for a in range(0, 500, 60)]
    out = [r for b in _nearest(3, 4)(iter(parts)) for r in b.to_pylist()]
    assert [r["id"] for r in out] == ids.tolist()
    for i, r in enumerate(out):
        near = sorted((float(((x[j] - x[i]) ** 2).sum()), j) for j in range(max(0, i - 24), min(500, i + 25)) if ids[j] != ids[i])[:4]
        assert [(n["other"], n["x"]) for n in r["near"]] == [(ids[j], x[j].tolist()) for _, j in near]
        assert all(math.isclose(n["distance"], d) for n, (d, _) in zip(r["near"], near))


def test_rows_of_one_file_are_dealt_to_all_cores(spark):
    from credal.session import dealt, part_count, written
    assert [part_count(n, 12) for n in (0, 100_000, 100_001, 10 ** 7, 10 ** 9)] == [None, None, 2, 12, None]
    one = written(spark.range(250_000).coalesce(1), "one-file")
    out = dealt(one, "dealt")
    sizes = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == min(spark.sparkContext.defaultParallelism, 3) and max(sizes) - min(sizes) <= 1000
    assert out.distinct().count() == 250_000
    few = written(spark.range(1000).coalesce(1), "few")
    assert dealt(few, "dealt") is few


def test_limits_that_a_fit_does_not_reach_cost_no_fit(spark, monkeypatch):
    from credal.operators import folds as FO
    from credal.operators import preprocess as P
    rng = random.Random(4)
    df = spark.createDataFrame([(i, rng.random(), int(rng.random() < 0.4), i % 2) for i in range(200)],
                               "id long, a double, y int, fold int")
    asked = []
    real = FO.estimator
    monkeypatch.setattr(FO, "estimator", lambda *a: asked.append(dict(a[1])) or real(*a))
    grid = {"logistic": {"C": [0.1, 1.0], "solver": ["lbfgs"], "max_iter": [1, 500, 1000]}}
    found = FO.candidates("logistic", grid["logistic"])
    fold = FO.fold_matrices(df, P.PreprocessSpec(standard=["a"], target="y"), "y", ["id"], "fold")[0]
    got = FO.fold_counts(fold, found, "y", 0.5, 2)
    assert sorted(s["maxIter"] for s in asked) == [1, 1, 1000, 1000]      # 500 is what 1000 gave
    assert [c for c, *_ in got] == found
    for c, _, *counts in got:
        model = real("logistic", c.settings(fold.n_train), fold.n_train, "y").fit(fold.train)
        from pyspark.ml.functions import vector_to_array
        hit = vector_to_array(F.col("probability"))[1] >= 0.5
        row = model.transform(fold.held_out).agg(F.count_if(~hit & (F.col("y") == 0)), F.count_if(hit & (F.col("y") == 0)),
                                                 F.count_if(~hit & (F.col("y") == 1)), F.count_if(hit & (F.col("y") == 1))).first()
        assert tuple(counts) == tuple(row)


def test_an_encoding_that_fits_memory_does_not_shuffle_the_matrix(spark, monkeypatch):
    from credal.operators import preprocess as P
    df = spark.range(2000).select((F.col("id") % 500).cast("string").alias("c"), (F.col("id") % 3).cast("int").alias("y"))
    spec = P.PreprocessSpec(target_enc=["c"], ordinal=["c2"], target="y")
    df = df.withColumn("c2", F.concat(F.lit("o"), "c"))
    plan = lambda p: P.transform(df, p)._jdf.queryExecution().optimizedPlan().toString()
    p = P.Params.from_json(P.fit(df, spec).to_json())
    assert len(p.small_tables) == 2 and plan(p).count("strategy=broadcast") == 2
    small = sorted(map(tuple, P.transform(df, p).collect()))
    monkeypatch.setattr(P, "BROADCAST_BYTES", 1000)
    p = P.fit(df, spec)
    assert not p.small_tables and "strategy=broadcast" not in plan(p)
    assert sorted(map(tuple, P.transform(df, p).collect())) == small
    assert p.te_global == df.agg(F.avg("y")).first()[0]


def test_rounding_equals_round(spark):
    from credal.plans.catalog import rounded
    rng = random.Random(3)
    odd = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, -1e-9, 1e-7, 5e-7, -5e-7, 1.5e-6, 0.1234565, 2.0000005,
           1e300, -1e22, 123456789.1234565, 999999.9999995, 1e6, 5e-324]
    values = odd + [rng.gauss(0, 10 ** rng.randint(-7, 9)) for _ in range(20_000)] + \
        [sign * (rng.randrange(10 ** 9) + 0.5) / 1e6 for sign in (1, -1) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    show = lambda rows: sorted(repr(r.v) for r in rows.collect())
    assert show(rounded(df)) == show(df.select(F.round("v", 6).alias("v")))
    assert "rint" in rounded(df)._jdf.queryExecution().toString().lower()


def test_the_champions_matrix_is_computed_once(spark):
    from credal.plans.credit_model import champion_and_threshold
    rng = random.Random(5)
    df = spark.createDataFrame([(i, rng.random(), int(rng.random() < 0.4)) for i in range(300)], "id long, a double, target int")
    matrix = df.withColumn("a", F.expr("a + length(sha2(cast(a AS string), 256))"))
    comparison, curve, final = champion_and_threshold(matrix, ["a"], "target", ["id"], models=("logistic", "decision_tree"))
    for out in (comparison, curve):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "sha2" not in plan and "UDF(" not in plan          # neither the matrix nor the scores again
    assert comparison.count() == 2 and curve.count() == 150 and final.transform(matrix).count() == 300
