"""Demo queries: splits, folds, confusion counts, threshold sweep, ranking metrics.

Stand-in scored table from the line items (renames and CASE only):
  y = returned line (flag R);  p = min(1, 5·(discount + tax) + 0.1·y)
  eval rows: shipped on or after 1999-01-01 (the rest is "train")
"""

from __future__ import annotations

from pyspark.sql import functions as F

from credal.operators import evaluate as M
from credal.plans.catalog import register, rounded, table


# (order, line number) repeats in the driver data; the whole row identifies a line
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def scored(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    y = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    p = F.least(F.lit(1.0), (F.col("l_discount") + F.col("l_tax")) * 5.0 + F.when(y == 1, 0.1).otherwise(0.0))
    p2 = F.least(F.lit(1.0), F.col("l_discount") * 8.0 + F.when(y == 1, 0.05).otherwise(0.0))
    return li.select(*ROW_KEY, y.alias("y"), p.alias("p"), p2.alias("p2"),
                     (F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")).alias("is_eval"))


SCORED_SQL = """
sc AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
         least(1.0::DOUBLE, (l_discount + l_tax) * 5.0::DOUBLE
                            + CASE WHEN l_returnflag = 'R' THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END) AS p,
         least(1.0::DOUBLE, l_discount * 8.0::DOUBLE
                            + CASE WHEN l_returnflag = 'R' THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END) AS p2,
         l_shipdate >= TIMESTAMP '1999-01-01' AS is_eval
  FROM lineitem)"""


SPLIT_SQL = "WITH" + SCORED_SQL + """
,
c AS (SELECT y, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM sc GROUP BY y),
t AS (SELECT *, CAST(ceil(0.2::DOUBLE * total) AS BIGINT) AS size FROM c),
q AS (SELECT *, n * size // total AS base,
        row_number() OVER (ORDER BY n * size % total DESC, n DESC, y) AS place, sum(n * size // total) OVER () AS dealt FROM t),
k AS (SELECT y, n, base + CASE WHEN place <= size - dealt THEN 1 ELSE 0 END AS test FROM q)
SELECT y, 'test' AS split, CAST(test AS BIGINT) AS n FROM k
UNION ALL
SELECT y, 'train', CAST(n - test AS BIGINT) FROM k
"""


@register("split_stratified", "M01", SPLIT_SQL)
def q_split(spark, sf_dir):
    """Exact stratified 80/20 split by hashed key: rows per (class, split)."""
    s = M.stratified_split(scored(spark, sf_dir), "y", ROW_KEY, 0.2, seed=42)
    return s.groupBy("y", "split").agg(F.count(F.lit(1)).alias("n"))


FOLDS_SQL = "WITH" + SCORED_SQL + """,
c AS (SELECT y, count(*) AS n FROM sc GROUP BY y)
SELECT y, CAST(f.fold AS INTEGER) AS fold,
       CAST(n // 5 + CASE WHEN f.fold < n % 5 THEN 1 ELSE 0 END AS BIGINT) AS n
FROM c, (SELECT range AS fold FROM range(5)) f
"""


@register("folds_stratified", "M02", FOLDS_SQL)
def q_folds(spark, sf_dir):
    """Stratified 5-fold assignment: rows per (class, fold)."""
    s = M.stratified_folds(scored(spark, sf_dir), "y", ROW_KEY, 5, seed=42)
    return s.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n"))


WEIGHTS_SQL = "WITH" + SCORED_SQL + """
SELECT y, round(CAST((SELECT count(*) FROM sc) AS DOUBLE) / (2 * count(*)), 6) AS weight
FROM sc GROUP BY y
"""


@register("class_weights", "M03", WEIGHTS_SQL)
def q_weights(spark, sf_dir):
    """Balanced class weights n / (2 · n_class) as a weight column per class."""
    sc = scored(spark, sf_dir)
    w = M.class_weights(sc, "y")
    return rounded(M.with_class_weight(sc, "y", w).select("y", "weight").distinct())


@register("baseline_classifier", "M05")
def q_baseline(spark, sf_dir):
    """Stratified random baseline labels (hash-uniform below the class rate)."""
    sc = scored(spark, sf_dir)
    rate = sc.agg(F.avg("y")).first()[0]
    b = M.baseline_labels(sc, ROW_KEY, rate, seed=42)
    return b.groupBy("y", "prediction").agg(F.count(F.lit(1)).alias("n"))


METRICS_SQL = "WITH" + SCORED_SQL + """,
c AS (
  SELECT count(*) FILTER (WHERE p < 0.5 AND y <> 1) AS tn, count(*) FILTER (WHERE p >= 0.5 AND y <> 1) AS fp,
         count(*) FILTER (WHERE p < 0.5 AND y = 1) AS fn, count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS tp
  FROM sc),
d AS (SELECT *, CAST(tn AS DOUBLE) AS tnd, CAST(fp AS DOUBLE) AS fpd, CAST(fn AS DOUBLE) AS fnd,
             CAST(tp AS DOUBLE) AS tpd FROM c),
e AS (SELECT *, CASE WHEN tpd + fpd > 0 THEN tpd / (tpd + fpd) ELSE 0.0 END AS prec,
             CASE WHEN tpd + fnd > 0 THEN tpd / (tpd + fnd) ELSE 0.0 END AS rec,
             (tpd + tnd) / (tpd + tnd + fpd + fnd) AS po,
             ((tpd + fpd) * (tpd + fnd) + (fnd + tnd) * (fpd + tnd)) / ((tpd + tnd + fpd + fnd) * (tpd + tnd + fpd + fnd)) AS pe
      FROM d)
SELECT tn, fp, fn, tp, round(po, 6) AS accuracy, round(prec, 6) AS precision, round(rec, 6) AS recall,
       round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END, 6) AS f1,
       round(CASE WHEN 4 * prec + rec > 0 THEN 5 * prec * rec / (4 * prec + rec) ELSE 0.0 END, 6) AS f2,
       round(tnd / (tnd + fpd), 6) AS specificity,
       round((tpd * tnd - fpd * fnd) / sqrt((tpd + fpd) * (tpd + fnd) * (tnd + fpd) * (tnd + fnd)), 6) AS mcc,
       round((po - pe) / (1 - pe), 6) AS cohen_kappa,
       round(10.0 * fnd + fpd, 6) AS cost
FROM e
"""


@register("confusion_metrics", "M08,M11", METRICS_SQL)
def q_metrics(spark, sf_dir):
    """Confusion counts at 0.5 and the point metrics derived from them."""
    c = M.confusion_counts(scored(spark, sf_dir), "p", "y", 0.5)
    return rounded(M.metrics_from_counts(c))


SWEEP_SQL = "WITH" + SCORED_SQL + """,
th AS (SELECT range AS j,
              CASE WHEN range = 149 THEN 0.80::DOUBLE
                   ELSE 0.05::DOUBLE + range * ((0.80::DOUBLE - 0.05::DOUBLE) / 149.0::DOUBLE) END AS t
       FROM range(150)),
c AS (
  SELECT j, t, count(*) FILTER (WHERE sc.p >= t AND y = 1) AS tp, count(*) FILTER (WHERE sc.p >= t AND y <> 1) AS fp,
         count(*) FILTER (WHERE sc.p < t AND y = 1) AS fn, count(*) FILTER (WHERE sc.p < t AND y <> 1) AS tn
  FROM th, sc GROUP BY j, t),
e AS (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS prec,
             CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS rec FROM c)
SELECT CAST(j AS INTEGER) AS j, round(t, 4) AS threshold,
       round(CASE WHEN 4 * prec + rec > 0 THEN 5 * prec * rec / (4 * prec + rec) ELSE 0.0 END, 6) AS f2,
       round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END, 6) AS f1,
       round(rec, 6) AS recall, round(prec, 6) AS precision,
       CAST(10 * fn + fp AS BIGINT) AS cost, fn, fp, tn, tp
FROM e
"""


@register("threshold_sweep", "M09", SWEEP_SQL)
def q_sweep(spark, sf_dir):
    """150-threshold sweep in [0.05, 0.80]: counts, precision/recall, F1/F2, cost."""
    return rounded(M.threshold_sweep(scored(spark, sf_dir), "p", "y", n=150))


BEST_SQL = SWEEP_SQL.replace("FROM e\n", "FROM e ORDER BY cost, j LIMIT 1\n")


@register("threshold_best", "M09,W01", BEST_SQL)
def q_best(spark, sf_dir):
    """Lowest business cost on the sweep (first threshold on ties)."""
    return rounded(M.best_threshold(M.threshold_sweep(scored(spark, sf_dir), "p", "y", n=150)))


AUC_SQL = "WITH" + SCORED_SQL + """,
t AS (SELECT p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM sc GROUP BY p),
a AS (SELECT p, pos, neg,
             coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
             sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpos,
             sum(neg) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg
      FROM t)
SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc,
       round(sum(pos * cpos / (cpos + cneg)) / sum(pos), 6) AS avg_precision
FROM a
"""


@register("ranking_metrics", "M10", AUC_SQL)
def q_auc(spark, sf_dir):
    """Exact ROC-AUC (ties one half) and average precision."""
    sc = scored(spark, sf_dir)
    auc = M.roc_auc(sc, "p", "y").first()["roc_auc"]
    ap = M.average_precision(sc, "p", "y")
    return rounded(ap.select(F.lit(auc).alias("roc_auc"), "avg_precision"))


LOGLOSS_SQL = "WITH" + SCORED_SQL + """
SELECT round(avg(-(y * ln(least(greatest(p, 1e-15), 1 - 1e-15))
                   + (1 - y) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))), 6) AS log_loss
FROM sc
"""


@register("log_loss", "M11", LOGLOSS_SQL)
def q_logloss(spark, sf_dir):
    """Binary cross-entropy with clipped probabilities."""
    return rounded(M.log_loss(scored(spark, sf_dir), "p", "y"))


def _f2_sql(where: str) -> str:
    return f"""(SELECT CASE WHEN 4 * pr + rc > 0 THEN 5 * pr * rc / (4 * pr + rc) ELSE 0.0 END FROM (
      SELECT CASE WHEN count(*) FILTER (WHERE p >= 0.5) > 0
                  THEN CAST(count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS DOUBLE) / count(*) FILTER (WHERE p >= 0.5)
                  ELSE 0.0 END AS pr,
             CASE WHEN count(*) FILTER (WHERE y = 1) > 0
                  THEN CAST(count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS DOUBLE) / count(*) FILTER (WHERE y = 1)
                  ELSE 0.0 END AS rc
      FROM sc WHERE {where}))"""


GAP_SQL = "WITH" + SCORED_SQL + f"""
SELECT 'p' AS model, round({_f2_sql('NOT is_eval')} - {_f2_sql('is_eval')}, 6) AS f2_gap,
       {_f2_sql('NOT is_eval')} - {_f2_sql('is_eval')} > 0.05 AS overfit
"""


@register("overfit_gap", "M12", GAP_SQL)
def q_gap(spark, sf_dir):
    """Train − eval F2 gap and the overfit flag."""
    sc = scored(spark, sf_dir)
    t = M.metrics_from_counts(M.confusion_counts(sc.where(~F.col("is_eval")), "p", "y", 0.5)).withColumn("model", F.lit("p"))
    e = M.metrics_from_counts(M.confusion_counts(sc.where("is_eval"), "p", "y", 0.5)).withColumn("model", F.lit("p"))
    return rounded(M.overfit_gap(t, e).select("model", "f2_gap", "overfit"))


COMPARE_SQL = "WITH" + SCORED_SQL + """,
m AS (
  SELECT 'p' AS model, count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS tp, count(*) FILTER (WHERE p >= 0.5 AND y <> 1) AS fp,
         count(*) FILTER (WHERE p < 0.5 AND y = 1) AS fn FROM sc
  UNION ALL
  SELECT 'p2', count(*) FILTER (WHERE p2 >= 0.5 AND y = 1), count(*) FILTER (WHERE p2 >= 0.5 AND y <> 1),
         count(*) FILTER (WHERE p2 < 0.5 AND y = 1) FROM sc),
e AS (SELECT model, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS pr,
             CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS rc FROM m),
f AS (SELECT model, CASE WHEN 4 * pr + rc > 0 THEN 5 * pr * rc / (4 * pr + rc) ELSE 0.0 END AS f2 FROM e)
SELECT model, round(f2, 6) AS f2, CAST(row_number() OVER (ORDER BY f2 DESC, model) AS INTEGER) AS rank,
       row_number() OVER (ORDER BY f2 DESC, model) = 1 AS champion
FROM f
"""


@register("model_comparison", "M13,W01", COMPARE_SQL)
def q_compare(spark, sf_dir):
    """Metric row per model (two score columns), ranked by F2, champion flagged."""
    sc = scored(spark, sf_dir)
    rows = None
    for name in ("p", "p2"):
        r = M.metrics_from_counts(M.confusion_counts(sc, name, "y", 0.5)).select(F.lit(name).alias("model"), "f2")
        rows = r if rows is None else rows.unionByName(r)
    return rounded(M.rank_models(rows, "f2"))


COMPARE_T_SQL = "WITH" + SCORED_SQL + """,
m AS (
  SELECT t AS threshold, count(*) FILTER (WHERE p >= t AND y = 1) AS tp, count(*) FILTER (WHERE p >= t AND y <> 1) AS fp,
         count(*) FILTER (WHERE p < t AND y = 1) AS fn
  FROM sc, (SELECT unnest([0.5::DOUBLE, 0.5383::DOUBLE]) AS t) GROUP BY t),
e AS (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS pr,
             CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS rc FROM m)
SELECT threshold, fn, fp, round(10.0 * fn + fp, 6) AS cost,
       round(CASE WHEN 4 * pr + rc > 0 THEN 5 * pr * rc / (4 * pr + rc) ELSE 0.0 END, 6) AS f2
FROM e
"""


@register("threshold_comparison", "M19", COMPARE_T_SQL)
def q_compare_t(spark, sf_dir):
    """fn, fp, cost and F2 at 0.50 against the published best threshold 0.5383."""
    return rounded(M.threshold_comparison(scored(spark, sf_dir), "p", "y", [0.5, 0.5383]))
