"""Demo queries: prediction-log monitoring and drift on the events table.

Stand-in prediction log (renames only): ts, request_id = event_id,
probability = value / 500, latency_ms = props.k, channel = event_type.
The decision is computed by the library's decision rule (threshold 0.1).
Reference population: events before 2024-01-16; current: the rest.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from credal.functions import clean as C
from credal.operators import aggregate as A
from credal.operators import monitor as D
from credal.plans.catalog import register, rounded, table

THRESHOLD = 0.1
SPLIT_TS = "2024-01-16"


def prediction_log(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    log = e.select("ts", F.col("event_id").alias("request_id"), (F.col("value") / 500.0).alias("probability"),
                   F.get_json_object("props", "$.k").cast("double").alias("latency_ms"),
                   F.col("event_type").alias("channel"), F.col("user_id"), F.col("value"))
    return log.withColumn("decision", C.decision("probability", THRESHOLD))


LOG_SQL = f"""
lg AS (
  SELECT ts, event_id AS request_id, value / 500.0 AS probability,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS latency_ms, event_type AS channel, user_id, value,
         CASE WHEN value / 500.0 < 0 OR value / 500.0 > 1 THEN NULL
              WHEN value / 500.0 < {THRESHOLD} THEN 'approved' ELSE 'refused' END AS decision,
         ts < TIMESTAMP '{SPLIT_TS}' AS is_ref
  FROM events)"""


KPI_SQL = "WITH" + LOG_SQL + """
SELECT count(*) AS total, count(*) FILTER (WHERE decision = 'approved') AS approvals,
       count(*) FILTER (WHERE decision = 'refused') AS refusals,
       round(CAST(count(*) FILTER (WHERE decision = 'refused') AS DOUBLE) / count(*), 6) AS refusal_rate,
       round(avg(probability), 6) AS mean_probability,
       round(quantile_cont(latency_ms, 0.5), 6) AS latency_p50, round(quantile_cont(latency_ms, 0.95), 6) AS latency_p95,
       round(quantile_cont(latency_ms, 0.99), 6) AS latency_p99
FROM lg
"""


@register("monitor_key_indicators", "D01,C29,S10", KPI_SQL)
def q_kpi(spark, sf_dir):
    """Totals, approvals, refusals, refusal rate, mean probability, latency percentiles."""
    return rounded(D.key_indicators(prediction_log(spark, sf_dir)))


HOURLY_SQL = "WITH" + LOG_SQL + """
SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(*) FILTER (WHERE decision = 'refused') AS refusals,
       round(CAST(count(*) FILTER (WHERE decision = 'refused') AS DOUBLE) / count(*), 6) AS refusal_rate
FROM lg GROUP BY 1
"""


@register("monitor_hourly_refusals", "A13,T02", HOURLY_SQL)
def q_hourly(spark, sf_dir):
    """Decisions per hour and the hourly refusal rate."""
    return rounded(D.hourly_refusal_rate(prediction_log(spark, sf_dir)))


HOURLY_DECISION_SQL = "WITH" + LOG_SQL + """
SELECT date_trunc('hour', ts) AS hour, decision, count(*) AS n FROM lg GROUP BY 1, 2
"""


@register("agg_hourly_decisions", "A13", HOURLY_DECISION_SQL)
def q_hourly_decisions(spark, sf_dir):
    """Rows per (hour, decision)."""
    return A.hourly_counts(prediction_log(spark, sf_dir), "ts", "decision")


LATENCY_SQL = "WITH" + LOG_SQL + """,
s AS (
  SELECT channel, min(latency_ms) AS min, quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.75) AS p75,
         quantile_cont(latency_ms, 0.95) AS p95, quantile_cont(latency_ms, 0.99) AS p99, max(latency_ms) AS max,
         avg(latency_ms) AS mean
  FROM lg GROUP BY channel)
SELECT channel, round(min, 6) AS min, round(p50, 6) AS p50, round(p75, 6) AS p75, round(p95, 6) AS p95,
       round(p99, 6) AS p99, round(max, 6) AS max, round(mean, 6) AS mean,
       round((SELECT mean FROM s WHERE channel = 'view') / mean, 6) AS speedup
FROM s
"""


@register("monitor_latency_statistics", "D09,A14", LATENCY_SQL)
def q_latency(spark, sf_dir):
    """Latency min/p50/p75/p95/p99/max/mean per channel and speed-up against 'view'."""
    return rounded(D.latency_statistics(prediction_log(spark, sf_dir), "channel", "latency_ms", baseline="view"))


PCT_SQL = "WITH" + LOG_SQL + """
SELECT decision, round(quantile_cont(latency_ms, 0.5), 6) AS p50, round(quantile_cont(latency_ms, 0.75), 6) AS p75,
       round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99,
       round(max(latency_ms), 6) AS max
FROM lg GROUP BY decision
"""


@register("agg_percentiles", "A14", PCT_SQL)
def q_pct(spark, sf_dir):
    """Exact linear-interpolated latency percentiles per decision."""
    return rounded(A.percentiles(prediction_log(spark, sf_dir), "latency_ms", keys=["decision"]))


HIST_SQL = "WITH" + LOG_SQL + """,
b AS (SELECT min(probability) AS lo, max(probability) AS hi FROM lg),
h AS (SELECT least(CAST(floor((probability - lo) / ((hi - lo) / 50)) AS INTEGER), 49) AS bin, decision
      FROM lg, b)
SELECT bin, decision, count(*) AS n,
       round((SELECT lo FROM b) + bin * (((SELECT hi FROM b) - (SELECT lo FROM b)) / 50), 6) AS bin_lo,
       round((SELECT lo FROM b) + (bin + 1) * (((SELECT hi FROM b) - (SELECT lo FROM b)) / 50), 6) AS bin_hi
FROM h GROUP BY bin, decision
"""


@register("agg_histogram", "A15", HIST_SQL)
def q_hist(spark, sf_dir):
    """50 equal-width probability bins by decision."""
    return rounded(A.histogram(prediction_log(spark, sf_dir), "probability", 50, by="decision"))


def _populations(spark, sf_dir):
    log = prediction_log(spark, sf_dir).withColumn("hour_of_day", F.hour("ts").cast("double"))
    ref = log.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"))
    cur = log.where(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp_ntz"))
    return ref, cur


NUM_DRIFT_SQL = "WITH" + LOG_SQL + """,
lg2 AS (SELECT *, CAST(hour(ts) AS DOUBLE) AS hour_of_day FROM lg),
long AS (SELECT 'value' AS "column", value AS v, is_ref FROM lg2
         UNION ALL SELECT 'latency_ms', latency_ms, is_ref FROM lg2
         UNION ALL SELECT 'hour_of_day', hour_of_day, is_ref FROM lg2),
cnt AS (SELECT "column", v, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur
        FROM long WHERE v IS NOT NULL GROUP BY ALL),
cum AS (SELECT *, sum(n_ref) OVER (PARTITION BY "column" ORDER BY v) / sum(n_ref) OVER (PARTITION BY "column") AS f_ref,
               sum(n_cur) OVER (PARTITION BY "column" ORDER BY v) / sum(n_cur) OVER (PARTITION BY "column") AS f_cur,
               lead(v) OVER (PARTITION BY "column" ORDER BY v) AS nv
        FROM cnt),
sd AS (SELECT "column", stddev_pop(v) AS sd FROM long WHERE is_ref GROUP BY ALL),
ksw AS (SELECT "column", max(abs(f_ref - f_cur)) AS ks,
               sum(CASE WHEN nv IS NOT NULL THEN abs(f_ref - f_cur) * (nv - v) ELSE 0 END) AS w
        FROM cum GROUP BY ALL),
edges AS (SELECT "column", quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e
          FROM long WHERE is_ref GROUP BY ALL),
binned AS (SELECT l."column", len(list_filter(list_distinct(e), lambda x: v > x)) AS bin, is_ref
           FROM long l JOIN edges USING ("column") WHERE v IS NOT NULL),
bc AS (SELECT "column", bin, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur
       FROM binned GROUP BY ALL),
pq AS (SELECT "column", n_ref, n_cur, CAST(n_ref AS DOUBLE) / sum(n_ref) OVER (PARTITION BY "column") AS p,
              CAST(n_cur AS DOUBLE) / sum(n_cur) OVER (PARTITION BY "column") AS q,
              sum(n_cur) OVER (PARTITION BY "column") AS ncur_tot FROM bc),
dv AS (SELECT "column",
              sum((greatest(q, 1e-4) - greatest(p, 1e-4)) * ln(greatest(q, 1e-4) / greatest(p, 1e-4))) AS psi,
              sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                                + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS js,
              sum(CASE WHEN p * ncur_tot > 0 THEN (n_cur - p * ncur_tot) ^ 2 / (p * ncur_tot) ELSE 0 END) AS chi2
       FROM pq GROUP BY ALL)
SELECT k."column", 'numerical' AS kind, round(ks, 6) AS ks, round(w / CASE WHEN sd > 0 THEN sd END, 6) AS wasserstein_norm,
       round(psi, 6) AS psi, round(js, 6) AS js, round(chi2, 6) AS chi2, js > 0.1 AS drifted
FROM ksw k JOIN sd USING ("column") JOIN dv USING ("column")
"""


@register("drift_numeric", "D03,D02", NUM_DRIFT_SQL)
def q_drift_num(spark, sf_dir):
    """KS, normalised Wasserstein, PSI, JS and χ² per numeric column (reference vs current)."""
    ref, cur = _populations(spark, sf_dir)
    numeric = D.common_numeric_columns(ref.select("value", "latency_ms", "hour_of_day"),
                                       cur.select("value", "latency_ms", "hour_of_day", "channel"))
    return rounded(D.drift_report(ref, cur, numeric=numeric))


CAT_DRIFT_SQL = "WITH" + LOG_SQL + """,
long AS (SELECT 'channel' AS "column", channel AS v, is_ref FROM lg
         UNION ALL SELECT 'decision', decision, is_ref FROM lg),
bc AS (SELECT "column", v, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur
       FROM long WHERE v IS NOT NULL GROUP BY ALL),
pq AS (SELECT "column", n_ref, n_cur, CAST(n_ref AS DOUBLE) / sum(n_ref) OVER (PARTITION BY "column") AS p,
              CAST(n_cur AS DOUBLE) / sum(n_cur) OVER (PARTITION BY "column") AS q,
              sum(n_cur) OVER (PARTITION BY "column") AS ncur_tot FROM bc)
SELECT "column", 'categorical' AS kind, CAST(NULL AS DOUBLE) AS ks, CAST(NULL AS DOUBLE) AS wasserstein_norm,
       round(sum((greatest(q, 1e-4) - greatest(p, 1e-4)) * ln(greatest(q, 1e-4) / greatest(p, 1e-4))), 6) AS psi,
       round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                               + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)), 6) AS js,
       round(sum(CASE WHEN p * ncur_tot > 0 THEN (n_cur - p * ncur_tot) ^ 2 / (p * ncur_tot) ELSE 0 END), 6) AS chi2,
       sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                         + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) > 0.1 AS drifted
FROM pq GROUP BY ALL
"""


@register("drift_categorical", "D03", CAT_DRIFT_SQL)
def q_drift_cat(spark, sf_dir):
    """JS distance, PSI and χ² per categorical column."""
    ref, cur = _populations(spark, sf_dir)
    return rounded(D.drift_report(ref, cur, categorical=["channel", "decision"]))


def _summary_sql() -> str:
    head, sep, tail = NUM_DRIFT_SQL.rstrip().rpartition('SELECT k."column"')
    return head.rstrip() + ",\nrep AS (" + sep + tail + """)
SELECT count(*) FILTER (WHERE drifted) AS drifted_columns, count(*) AS total_columns,
       round(CAST(count(*) FILTER (WHERE drifted) AS DOUBLE) / count(*), 6) AS drift_share,
       CAST(count(*) FILTER (WHERE drifted) AS DOUBLE) / count(*) >= 0.5 AS dataset_drift,
       (SELECT count(*) FROM lg WHERE is_ref) AS n_reference, (SELECT count(*) FROM lg WHERE NOT is_ref) AS n_current
FROM rep
"""


@register("drift_dataset_summary", "D04", _summary_sql())
def q_drift_summary(spark, sf_dir):
    """Drift flag, number and share of drifted columns, population sizes."""
    ref, cur = _populations(spark, sf_dir)
    rep = D.drift_report(ref, cur, numeric=["value", "latency_ms", "hour_of_day"])
    return rounded(D.dataset_drift(rep, 0.5, n_ref=ref.count(), n_cur=cur.count()))


def _alerts_sql() -> str:
    head, sep, tail = NUM_DRIFT_SQL.rstrip().rpartition('SELECT k."column"')
    return head.rstrip() + ",\nrep AS (" + sep + tail + """)
SELECT 'data_drift' AS alert_type, max(ks) AS score, CAST(0.01 AS DOUBLE) AS threshold,
       string_agg("column", ',' ORDER BY "column") AS affected_features, 'open' AS status
FROM rep WHERE ks > 0.01 HAVING count(*) > 0
"""


@register("drift_alerts", "D08", _alerts_sql())
def q_drift_alerts(spark, sf_dir):
    """Alert row listing the drifted columns (JS above 0.1), if any; KS alert otherwise."""
    ref, cur = _populations(spark, sf_dir)
    rep = D.drift_report(ref, cur, numeric=["value", "latency_ms", "hour_of_day"], categorical=["channel"])
    alerts = D.drift_alerts(rep, stat="ks", threshold=0.01)
    return rounded(alerts.withColumn("affected_features", F.array_join("affected_features", ",")))


QUALITY_SQL = "WITH" + LOG_SQL + """
SELECT 'value' AS "column", count(*) FILTER (WHERE value IS NULL) AS missing, count(DISTINCT value) AS distinct_count,
       round(min(value), 6) AS min, round(max(value), 6) AS max, CASE WHEN is_ref THEN 'reference' ELSE 'current' END AS population
FROM lg GROUP BY is_ref
UNION ALL
SELECT 'latency_ms', count(*) FILTER (WHERE latency_ms IS NULL), count(DISTINCT latency_ms), round(min(latency_ms), 6),
       round(max(latency_ms), 6), CASE WHEN is_ref THEN 'reference' ELSE 'current' END
FROM lg GROUP BY is_ref
"""


@register("drift_quality_summary", "D05,Q01", QUALITY_SQL)
def q_quality(spark, sf_dir):
    """Missing, distinct, min, max per column for both populations."""
    ref, cur = _populations(spark, sf_dir)
    cols = ["value", "latency_ms"]
    return rounded(D.quality_summary(ref, cols, "reference").unionByName(D.quality_summary(cur, cols, "current")))


METRICS_SQL = "WITH" + LOG_SQL + """,
k AS (SELECT CAST(count(*) AS DOUBLE) AS total, round(avg(probability), 6) AS mean_probability,
             round(quantile_cont(latency_ms, 0.95), 6) AS latency_p95 FROM lg)
SELECT 'total' AS metric_name, total AS metric_value, 'reference' AS metric_type FROM k
UNION ALL SELECT 'mean_probability', mean_probability, 'reference' FROM k
UNION ALL SELECT 'latency_p95', latency_p95, 'reference' FROM k
"""


@register("metric_registration", "D07", METRICS_SQL)
def q_metric_rows(spark, sf_dir):
    """Key indicators unpivoted to (metric_name, metric_value, metric_type) rows
    and appended to a monitoring-metrics table (read back)."""
    from credal.sources import io
    k = rounded(D.key_indicators(prediction_log(spark, sf_dir))).select("total", "mean_probability", "latency_p95")
    path = io.scratch_dir(spark, "monitoring-metrics")
    io.write_table(D.metric_rows(k, "reference"), path, mode="append")
    return spark.read.parquet(path)


VOLUME_SQL = """
SELECT (SELECT count(*) FROM (SELECT 1 FROM events LIMIT 10)) >= 10 AS has_minimum_volume
"""


@register("minimum_volume_guard", "D06", VOLUME_SQL)
def q_volume(spark, sf_dir):
    """The drift job refuses logs with fewer than 10 rows (reads at most 10)."""
    log = prediction_log(spark, sf_dir)
    return spark.createDataFrame([(D.has_minimum_volume(log, 10),)], "has_minimum_volume boolean")


ALIGN_SQL = "WITH" + LOG_SQL + """
SELECT request_id, CAST(value AS DOUBLE) AS amt_credit, -365.0 * CAST(user_id AS DOUBLE) + 0.0 AS days_birth,
       round(latency_ms, 6) AS latency_ms, 0.0 AS ext_source_1
FROM lg
"""


@register("population_alignment", "D02,C30,W07", ALIGN_SQL)
def q_align(spark, sf_dir):
    """Request fields renamed, years → −365·days, fitted column order with 0.0 fill."""
    log = prediction_log(spark, sf_dir).select("request_id", "value", F.col("user_id").alias("age"), "latency_ms")
    out = D.align_population(log, {"value": "amt_credit", "age": "days_birth"}, day_to_years=["days_birth"],
                             columns=["amt_credit", "days_birth", "latency_ms", "ext_source_1"], keep=["request_id"])
    return rounded(out)


PERF_SQL = """
WITH v AS (SELECT n_nationkey AS model_version_id, n_name AS model_name FROM nation),
rq AS (SELECT c_custkey AS request_id, c_nationkey AS model_version_id FROM customer),
rs AS (SELECT o_custkey AS request_id, o_totalprice / 500000.0 AS confidence, CAST(o_orderkey % 97 AS DOUBLE) AS latency_ms,
              o_orderstatus = 'F' AS success FROM orders)
SELECT v.model_version_id, v.model_name, count(rq.request_id) AS requests, round(avg(rs.confidence), 6) AS avg_confidence,
       round(avg(rs.latency_ms), 6) AS avg_latency_ms, count(*) FILTER (WHERE rs.success) AS successes
FROM v LEFT JOIN rq ON v.model_version_id = rq.model_version_id LEFT JOIN rs ON rq.request_id = rs.request_id
GROUP BY v.model_version_id, v.model_name
"""


@register("model_performance_join", "J07,A17", PERF_SQL)
def q_perf(spark, sf_dir):
    """Model versions ⟕ requests ⟕ results aggregated per version."""
    v = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("model_version_id"),
                                              F.col("n_name").alias("model_name"))
    rq = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("request_id"),
                                                 F.col("c_nationkey").alias("model_version_id"))
    rs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("request_id"),
                                               (F.col("o_totalprice") / 500000.0).alias("confidence"),
                                               (F.col("o_orderkey") % 97).cast("double").alias("latency_ms"),
                                               (F.col("o_orderstatus") == "F").alias("success"))
    return rounded(D.model_performance(v, rq, rs))
