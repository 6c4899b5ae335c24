"""Splits, folds and evaluation metrics as Spark jobs.

Design points for scale:

* Exact stratified splits and folds without a window over a class (a class
  can hold most of the rows, and a window would put it in one task). Each
  row gets a repeatable 64-bit hash of its key; the k-th smallest hash of
  every class is found by radix refinement — a few small grouped counts over
  16-bit slices of the hash — and rows are assigned by comparing with those
  thresholds. Sizes are exact for distinct keys and independent of the
  partitioning; copies of one key always land on the same side.
* Threshold sweeps bin every score once to its threshold index and
  aggregate, then take a reverse cumulative sum over at most ``n + 1`` rows.
* Exact ROC-AUC / average precision aggregate per distinct score and take
  cumulative sums through :func:`cumulative_by_key`, which splits the key
  range into quantile buckets so no window ever holds more than one bucket.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FN_COST = 10.0
FP_COST = 1.0


# hashing -------------------------------------------------------------------------
def key_hash(cols: Sequence[str], seed: int = 42) -> Column:
    """Repeatable signed 64-bit hash of the key columns and a seed."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])


def hash_uniform(cols: Sequence[str], seed: int = 42) -> Column:
    """Repeatable uniform value in [0, 1) from the key columns."""
    h = key_hash(cols, seed)
    return (F.shiftright(h, 11).cast("double") + F.lit(2.0 ** 52)) / F.lit(2.0 ** 53)


# exact k-th smallest hash per class ----------------------------------------------------
def rank_thresholds(df: DataFrame, group: str, hash_col: str, targets: Mapping[object, Sequence[int]]
                    ) -> dict[object, list[int | None]]:
    """For every group value and every target count ``t`` return the hash
    value ``v`` of the ``t``-th smallest row (1-based), so that
    ``hash <= v`` selects exactly ``t`` rows of the group (``None`` for 0).

    Four passes (16 bits each); each pass is one grouped count over the rows of
    the still-open bins, and its at most 65,536 counts per open bin go to the
    driver, whatever the number of rows.
    """
    # state per (group, index): (prefix bin at current level, residual count)
    open_: dict[tuple, tuple[int | None, int]] = {}
    result: dict[object, list[int | None]] = {g: [None] * len(ts) for g, ts in targets.items()}
    for g, ts in targets.items():
        for i, t in enumerate(ts):
            if t > 0:
                open_[(g, i)] = (None, int(t))
    for shift in (48, 32, 16, 0):
        if not open_:
            break
        parents = {(g, pb) for (g, _), (pb, _) in open_.items()}
        # rows of the open parent bins only (the first pass reads everything)
        if shift == 48:
            sub = df
        else:
            ps = shift + 16
            cond = None
            for g, pb in parents:
                c = (F.col(group) == F.lit(g)) & (F.shiftright(F.col(hash_col), ps) == F.lit(pb))
                cond = c if cond is None else (cond | c)
            sub = df.where(cond)
        ps = shift + 16
        parent_expr = F.shiftright(F.col(hash_col), ps) if shift < 48 else F.lit(0).cast("long")
        counts = (sub.groupBy(F.col(group).alias("g"), parent_expr.alias("pb"),
                              F.shiftright(F.col(hash_col), shift).alias("b"))
                  .agg(F.count(F.lit(1)).alias("n")).collect())
        bins: dict[tuple, list[tuple[int, int]]] = {}
        for r in counts:
            bins.setdefault((r["g"], r["pb"] if shift < 48 else None), []).append((r["b"], r["n"]))
        new_open = {}
        for (g, i), (pb, resid) in open_.items():
            acc = 0
            for b, n in sorted(bins.get((g, pb), [])):
                if acc + n >= resid:
                    if shift == 0:
                        result[g][i] = b
                    else:
                        new_open[(g, i)] = (b, resid - acc)
                    break
                acc += n
        open_ = new_open
    return result


def _class_counts(df: DataFrame, label: str) -> dict:
    """Rows per non-null class (one small grouped count)."""
    return {r[0]: r[1] for r in df.groupBy(label).agg(F.count(F.lit(1))).collect() if r[0] is not None}


def _assign_by_thresholds(hcol: Column, label: str, thresholds: Mapping[object, Sequence[int | None]]) -> Column:
    """Number of thresholds of the row's class below or at its hash."""
    expr = None
    for g, ths in thresholds.items():
        cnt = sum(F.when(hcol <= F.lit(t), 1).otherwise(0) if t is not None else F.lit(0) for t in ths) \
            if ths else F.lit(0)
        cond = F.col(label) == F.lit(g) if g is not None else F.col(label).isNull()
        expr = F.when(cond, cnt) if expr is None else expr.when(cond, cnt)
    return expr


def stratified_split(df: DataFrame, label: str, key: Sequence[str] | str, test_fraction: float = 0.2,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """A test part of ``ceil(n · fraction)`` rows in all, dealt to the classes
    in proportion (largest remainder; ties to the larger class, then the smaller
    label), seeded, disjoint, independent of the partitioning. Rows with a NULL
    label leave. Adds ``out`` ∈ {train, test}.

    ``key`` must identify a row (use every column when there is no id):
    rows sharing a key share a hash, so copies stay on one side and the size
    can exceed the target by the copies tied at the boundary."""
    key = [key] if isinstance(key, str) else list(key)
    h = df.where(F.col(label).isNotNull()).withColumn("__h", key_hash(key, seed))
    counts = _class_counts(df, label)
    total = sum(counts.values())
    size = math.ceil(test_fraction * total)
    share = {g: divmod(n * size, max(total, 1)) for g, n in counts.items()}
    extra = size - sum(q for q, _ in share.values())
    lucky = sorted(counts, key=lambda g: (-share[g][1], -counts[g], g))[:extra]
    targets = {g: [share[g][0] + (g in lucky)] for g in counts}
    if not targets:
        return h.withColumn(out, F.lit("train")).drop("__h")
    th = rank_thresholds(h, label, "__h", targets)
    part = _assign_by_thresholds(F.col("__h"), label, th)
    return h.withColumn(out, F.when(part >= 1, F.lit("test")).otherwise(F.lit("train"))).drop("__h")


def stratified_folds(df: DataFrame, label: str, key: Sequence[str] | str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Stratified k-fold ids; fold sizes of a class differ by at most one
    (the first ``n mod k`` folds get the extra row, as in scikit-learn)."""
    key = [key] if isinstance(key, str) else list(key)
    h = df.withColumn("__h", key_hash(key, seed))
    counts = _class_counts(df, label)
    targets = {}
    for g, n in counts.items():
        sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
        cum, acc = [], 0
        for s in sizes[:-1]:
            acc += s
            cum.append(acc)
        targets[g] = cum
    th = rank_thresholds(h, label, "__h", targets)
    # fold = number of fold boundaries strictly below the row's rank
    expr = None
    for g, ths in th.items():
        cnt = sum((F.when(F.col("__h") > F.lit(t), 1).otherwise(0) if t is not None else F.lit(1)) for t in ths) \
            if ths else F.lit(0)
        cond = F.col(label) == F.lit(g) if g is not None else F.col(label).isNull()
        expr = F.when(cond, cnt) if expr is None else expr.when(cond, cnt)
    return h.withColumn(out, expr.cast("int")).drop("__h")


def class_weights(df: DataFrame, label: str) -> dict:
    """Balanced weights n / (n_classes · n_class)."""
    counts = _class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    return {g: n / (k * c) for g, c in counts.items()}


def with_class_weight(df: DataFrame, label: str, weights: Mapping[object, float], out: str = "weight") -> DataFrame:
    """Weight column for ``weightCol`` of the Spark ML estimators."""
    expr = None
    for g, w in weights.items():
        cond = F.col(label) == F.lit(g)
        expr = F.when(cond, F.lit(float(w))) if expr is None else expr.when(cond, F.lit(float(w)))
    return df.withColumn(out, expr.otherwise(F.lit(1.0)))


def baseline_labels(df: DataFrame, key: Sequence[str] | str, positive_rate: float, seed: int = 42,
                    out: str = "prediction") -> DataFrame:
    """Stratified random baseline — label 1 with the class rate."""
    key = [key] if isinstance(key, str) else list(key)
    return df.withColumn(out, F.when(hash_uniform(key, seed) < F.lit(positive_rate), 1).otherwise(0))


# confusion counts and metrics ---------------------------------------------------------
def confusion_counts(df: DataFrame, score: str, label: str, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """Tn, fp, fn, tp for ``score >= threshold`` in one aggregate."""
    pred = F.col(score) >= F.lit(threshold)
    y = F.col(label) == 1
    g = df.groupBy(*keys) if keys else df.groupBy()
    return g.agg(F.count_if(~pred & ~y).alias("tn"), F.count_if(pred & ~y).alias("fp"),
                 F.count_if(~pred & y).alias("fn"), F.count_if(pred & y).alias("tp"))


def _div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a.cast("double") / b).otherwise(F.lit(0.0))


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    b2 = beta * beta
    den = F.lit(b2) * precision + recall
    return F.when(den > 0, F.lit(1 + b2) * precision * recall / den).otherwise(F.lit(0.0))


def metrics_from_counts(counts: DataFrame, fn_cost: float = FN_COST, fp_cost: float = FP_COST) -> DataFrame:
    """Accuracy, precision, recall, F1, F2, specificity, MCC, Cohen κ and
    business cost from the four counts (0 when undefined)."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    prec = _div(tp, tp + fp)
    rec = _div(tp, tp + fn)
    mcc_den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    po = _div(tp + tn, n)
    pe = _div((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    return counts.select(
        "*",
        po.alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        f_beta(prec, rec, 1.0).alias("f1"), f_beta(prec, rec, 2.0).alias("f2"),
        _div(tn, tn + fp).alias("specificity"),
        F.when(mcc_den > 0, (tp * tn - fp * fn) / mcc_den).otherwise(F.lit(0.0)).alias("mcc"),
        F.when(F.lit(1.0) - pe != 0, (po - pe) / (F.lit(1.0) - pe)).otherwise(F.lit(0.0)).alias("cohen_kappa"),
        (F.lit(fn_cost) * fn + F.lit(fp_cost) * fp).alias("cost"))


def log_loss(df: DataFrame, score: str, label: str, eps: float = 1e-15) -> DataFrame:
    """Mean binary cross-entropy with clipped probabilities."""
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return df.agg(F.avg(-(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))).alias("log_loss"))


def linspace(lo: float, hi: float, n: int) -> list[float]:
    """Thresholds as numpy's linspace computes them."""
    if n == 1:
        return [lo]
    step = (hi - lo) / (n - 1)
    vals = [lo + i * step for i in range(n)]
    vals[-1] = hi
    return vals


def threshold_sweep(df: DataFrame, score: str, label: str, n: int = 150, lo: float = 0.05, hi: float = 0.80,
                    fn_cost: float = FN_COST, fp_cost: float = FP_COST) -> DataFrame:
    """Confusion counts and metrics at ``n`` thresholds in one pass.

    Each score gets idx = #{thresholds ≤ score} (a floor plus an exact
    ±1 correction against the literal threshold array), the data is reduced
    to counts per (idx, label), and the counts at threshold j are reverse
    cumulative sums over idx > j — a window over at most n + 1 rows.
    """
    ths = linspace(lo, hi, n)
    step = (hi - lo) / (n - 1) if n > 1 else 1.0
    arr = F.array(*[F.lit(float(t)) for t in ths])
    s = F.col(score)
    guess = F.least(F.greatest(F.floor((s - F.lit(lo)) / F.lit(step)).cast("int") + 1, F.lit(0)), F.lit(n))
    # exact correction: idx must satisfy t[idx-1] <= s < t[idx]
    up = F.when((guess < n) & (s >= F.element_at(arr, guess + 1)), guess + 1).otherwise(guess)
    idx = F.when((up > 0) & (s < F.element_at(arr, F.greatest(up, F.lit(1)))), up - 1).otherwise(up)
    binned = (df.where(s.isNotNull()).groupBy(idx.alias("idx"))
              .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))
    # every index 0..n present, then reverse running sums over these n + 1 rows
    grid = df.sparkSession.range(0, n + 1).select(F.col("id").cast("int").alias("idx"))
    b = grid.join(binned, "idx", "left").fillna(0, subset=["pos", "neg"])
    w = Window.orderBy(F.col("idx").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(F.lit(0))
    b = b.select("idx", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
                 F.sum("pos").over(whole).alias("P"), F.sum("neg").over(whole).alias("N"))
    # threshold j (0-based) predicts positive for idx >= j + 1
    c = b.where(F.col("idx") >= 1).select(
        (F.col("idx") - 1).alias("j"), F.element_at(arr, F.col("idx")).alias("threshold"), "tp", "fp",
        (F.col("P") - F.col("tp")).alias("fn"), (F.col("N") - F.col("fp")).alias("tn"))
    m = metrics_from_counts(c, fn_cost, fp_cost)
    return m.select("j", F.round("threshold", 4).alias("threshold"), "f2", "f1", "recall", "precision",
                    F.col("cost").cast("long").alias("cost"), F.col("fn").cast("long").alias("fn"),
                    F.col("fp").cast("long").alias("fp"), F.col("tn").cast("long").alias("tn"),
                    F.col("tp").cast("long").alias("tp"))


def best_threshold(sweep: DataFrame, by: str = "cost") -> DataFrame:
    """Lowest cost (first threshold on ties) or highest F2."""
    order = [F.col("cost").asc(), F.col("j").asc()] if by == "cost" else [F.col("f2").desc(), F.col("j").asc()]
    return sweep.orderBy(*order).limit(1)


# cumulative sums over a sorted key -------------------------------------------------------
def cumulative_by_key(df: DataFrame, key: str, values: Sequence[str], descending: bool = False,
                      buckets: int | None = None) -> DataFrame:
    """Inclusive running sums of ``values`` in ``key`` order (exact, bucketed:
    see :mod:`credal.operators.cumulative`)."""
    from credal.operators.cumulative import cumulative_sums
    return cumulative_sums(df, key, values, descending=descending, buckets=buckets)


def _score_table(df: DataFrame, score: str, label: str) -> DataFrame:
    return (df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("s"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))


def roc_auc(df: DataFrame, score: str, label: str, buckets: int | None = None) -> DataFrame:
    """Exact ROC-AUC, ties counted one half (= Mann–Whitney with average
    ranks): Σ_s pos_s · (neg_below_s + neg_s / 2) / (P · N)."""
    t = cumulative_by_key(_score_table(df, score, label), "s", ["neg"], buckets=buckets)
    contrib = F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)
    return t.agg((F.sum(contrib) / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def average_precision(df: DataFrame, score: str, label: str, buckets: int | None = None) -> DataFrame:
    """Σ_s (pos_s / P) · precision at threshold s (scores descending)."""
    t = cumulative_by_key(_score_table(df, score, label), "s", ["pos", "neg"], descending=True, buckets=buckets)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return t.agg((F.sum(F.col("pos") * prec) / F.sum("pos")).alias("avg_precision"))


def evaluate_scores(df: DataFrame, score: str, label: str, threshold: float, name: str = "model",
                    fn_cost: float = FN_COST, fp_cost: float = FP_COST) -> DataFrame:
    """One metric row per model: counts, point metrics, ROC-AUC, AP, log-loss."""
    m = metrics_from_counts(confusion_counts(df, score, label, threshold), fn_cost, fp_cost)
    auc = roc_auc(df, score, label).first()["roc_auc"]
    ap = average_precision(df, score, label).first()["avg_precision"]
    ll = log_loss(df, score, label).first()["log_loss"]
    return m.select(F.lit(name).alias("model"), F.lit(float(threshold)).alias("threshold"), "*",
                    F.lit(auc).alias("roc_auc"), F.lit(ap).alias("avg_precision"), F.lit(ll).alias("log_loss"))


def overfit_gap(train_row: DataFrame, eval_row: DataFrame, limit: float = 0.05) -> DataFrame:
    """Train − eval F1/F2 and a flag when the F2 gap exceeds ``limit``."""
    t = train_row.select(F.col("model"), F.col("f1").alias("f1_train"), F.col("f2").alias("f2_train"))
    e = eval_row.select(F.col("model"), F.col("f1").alias("f1_eval"), F.col("f2").alias("f2_eval"))
    j = t.join(e, "model")
    return j.select("model", (F.col("f1_train") - F.col("f1_eval")).alias("f1_gap"),
                    (F.col("f2_train") - F.col("f2_eval")).alias("f2_gap"),
                    ((F.col("f2_train") - F.col("f2_eval")) > F.lit(limit)).alias("overfit"))


def rank_models(rows: DataFrame, by: str = "f2") -> DataFrame:
    """Rank by ``by`` descending (name breaks ties), champion first.
    The window covers the comparison table (one row per model)."""
    w = Window.orderBy(F.col(by).desc(), F.col("model").asc())
    return rows.withColumn("rank", F.row_number().over(w)).withColumn("champion", F.col("rank") == 1)


def threshold_comparison(df: DataFrame, score: str, label: str, thresholds: Sequence[float],
                         fn_cost: float = FN_COST, fp_cost: float = FP_COST) -> DataFrame:
    """Fn, fp, cost and F2 at a few thresholds (e.g. 0.50 and the best)."""
    g = df.groupBy()
    aggs = []
    for i, t in enumerate(thresholds):
        pred = F.col(score) >= F.lit(t)
        y = F.col(label) == 1
        aggs += [F.count_if(~pred & ~y).alias(f"tn_{i}"), F.count_if(pred & ~y).alias(f"fp_{i}"),
                 F.count_if(~pred & y).alias(f"fn_{i}"), F.count_if(pred & y).alias(f"tp_{i}")]
    wide = g.agg(*aggs)
    stack = ", ".join(f"{float(t)}D, tn_{i}, fp_{i}, fn_{i}, tp_{i}" for i, t in enumerate(thresholds))
    long = wide.selectExpr(f"stack({len(thresholds)}, {stack}) AS (threshold, tn, fp, fn, tp)")
    return metrics_from_counts(long, fn_cost, fp_cost).select("threshold", "fn", "fp", "cost", "f2")
