"""Prediction-log monitoring and drift.

Drift is computed for all columns in one long-format job: the two
populations are unpivoted to ``(column, value, population)``, reduced to
counts per distinct value (partial aggregation first), and every statistic
is read from those counts:

  numeric     KS = max |F_ref − F_cur| over merged cumulative counts;
              Wasserstein-1 = Σ |F_ref − F_cur| · Δx, normalised by σ_ref;
              PSI and Jensen–Shannon distance over reference-decile bins
  categorical Jensen–Shannon distance and χ² statistic over category shares

Cumulative counts use bucketed windows (:mod:`credal.operators.cumulative`),
so a column with many distinct values never sits in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.functions import clean as C
from credal.functions.stats import chi2_pvalue, ks_pvalue
from credal.operators.cumulative import bucket_count, cumulative_sums
from credal.operators.quantiles import grouped_exact_quantiles, quantiles
from credal.session import written

PSI_EPS = 1e-4


# D01 / D06 / D09 ---------------------------------------------------------------------
def key_indicators(log: DataFrame, decision: str = "decision", probability: str = "probability",
                   latency: str = "latency_ms", refused: str = C.REFUSED, approved: str = C.APPROVED,
                   exact: bool = True) -> DataFrame:
    """Totals, approvals, refusals, refusal rate, mean probability and
    p50/p95/p99 latency in one aggregate."""
    q = quantiles(log, [latency], [0.5, 0.95, 0.99], "exact" if exact else "approx")[latency]
    r = log.agg(F.count(F.lit(1)).alias("total"),
                F.count_if(F.col(decision) == approved).alias("approvals"),
                F.count_if(F.col(decision) == refused).alias("refusals"),
                F.avg(F.col(probability)).alias("mean_probability"))
    return r.select("total", "approvals", "refusals",
                    F.when(F.col("total") > 0, F.col("refusals") / F.col("total")).alias("refusal_rate"),
                    "mean_probability", *[F.lit(v).cast("double").alias(n)
                                          for v, n in zip(q, ("latency_p50", "latency_p95", "latency_p99"))])


def has_minimum_volume(log: DataFrame, minimum: int = 10) -> bool:
    """At least ``minimum`` rows (reads no more than ``minimum`` rows)."""
    return log.limit(minimum).count() >= minimum


def latency_statistics(df: DataFrame, engine: str, latency: str, baseline: str | None = None) -> DataFrame:
    """min/p50/p75/p95/p99/max/mean per engine and the speed-up of the
    mean against ``baseline``'s mean."""
    q = grouped_exact_quantiles(df, [engine], latency, (0.5, 0.75, 0.95, 0.99), ("p50", "p75", "p95", "p99"))
    s = df.groupBy(engine).agg(F.min(latency).alias("min"), F.max(latency).alias("max"), F.avg(latency).alias("mean"))
    from credal.operators.assemble import join_on_keys
    s = join_on_keys(s, q, [engine]).select(engine, "min", "p50", "p75", "p95", "p99", "max", "mean")
    if baseline is not None:
        base = s.where(F.col(engine) == baseline).select(F.col("mean").alias("_bm"))
        bm = base.first()
        s = s.withColumn("speedup", F.lit(bm[0] if bm else None) / F.col("mean"))
    return s


def hourly_refusal_rate(log: DataFrame, ts: str = "ts", decision: str = "decision",
                        refused: str = C.REFUSED) -> DataFrame:
    """A13 + refusal rate per hour."""
    return (log.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(decision) == refused).alias("refusals"))
            .withColumn("refusal_rate", F.col("refusals") / F.col("n")))


# D02 --------------------------------------------------------------------------------
def common_numeric_columns(ref: DataFrame, cur: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """D02 (first form): numeric columns present in both populations, in the
    reference order."""
    num = ("double", "float", "integer", "long", "short", "byte", "decimal")
    cur_types = dict((f.name, f.dataType.typeName()) for f in cur.schema.fields)
    return [f.name for f in ref.schema.fields if f.name not in exclude and f.dataType.typeName() in num
            and cur_types.get(f.name) in num]


def align_population(df: DataFrame, renames: dict[str, str], day_to_years: Sequence[str] = (),
                     columns: Sequence[str] | None = None, fill: float = 0.0, keep: Sequence[str] = (),
                     categorical: Sequence[str] = ()) -> DataFrame:
    """Rename request fields, convert ``age``/``years`` fields to
    negative day offsets (−365 × value), then keep the fitted column order
    with missing numeric columns as ``fill`` (categorical ones missing) — one
    ``select`` over the whole log."""
    out = df
    for src, dst in renames.items():
        if src in out.columns:
            out = out.withColumnRenamed(src, dst)
    for c in day_to_years:
        if c in out.columns:
            out = out.withColumn(c, F.lit(-365.0) * F.col(c))
    if columns is not None:
        have = set(out.columns)
        cat = set(categorical)
        out = out.select(*keep, *[
            (F.col(c).cast("string") if c in cat else F.col(c).cast("double")) if c in have
            else (F.lit(None).cast("string") if c in cat else F.lit(fill).cast("double")).alias(c)
            for c in columns])
    return out


# D03 --------------------------------------------------------------------------------
def _long(ref: DataFrame, cur: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Unpivot both populations to (column, value, pop) and count per value."""
    def one(df, pop):
        cast = "double" if kind == "num" else "string"
        arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias("value")) for c in columns])
        return df.select(F.explode(arr).alias("kv")).select("kv.column", "kv.value", F.lit(pop).alias("pop"))
    u = one(ref, "ref").unionByName(one(cur, "cur")).where(F.col("value").isNotNull())
    if kind == "num":
        u = u.where(~F.isnan("value"))
    return u.groupBy("column", "value").agg(F.count_if(F.col("pop") == "ref").alias("n_ref"),
                                            F.count_if(F.col("pop") == "cur").alias("n_cur"))


def numeric_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str], bins: int = 10,
                  buckets: int | None = None) -> DataFrame:
    """D03 numeric: ks, wasserstein_norm, psi, js per column."""
    counts = written(_long(ref, cur, columns, "num"), "drift")
    # population sizes per column: one row per column (bounded by the column list)
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"))
    # running counts and the next distinct value (Δx) in one bucketed pass
    c = cumulative_sums(counts, "value", ["n_ref", "n_cur"], partition=["column"],
                        buckets=buckets or bucket_count(counts.count()), with_next=True)
    c = c.join(F.broadcast(totals), "column")  # one row per column
    c = c.withColumn("F_ref", F.col("cum_n_ref") / F.col("tot_ref")).withColumn("F_cur", F.col("cum_n_cur") / F.col("tot_cur"))
    ks_w = c.groupBy("column").agg(
        F.max(F.abs(F.col("F_ref") - F.col("F_cur"))).alias("ks"),
        F.sum(F.when(F.col("next_value").isNotNull(),
                     F.abs(F.col("F_ref") - F.col("F_cur")) * (F.col("next_value") - F.col("value")))
              .otherwise(0.0)).alias("wasserstein"),
        (F.sum(F.col("n_ref") * F.col("value")) / F.sum("n_ref")).alias("_mu"),
        (F.sum(F.col("n_ref") * F.col("value") * F.col("value")) / F.sum("n_ref")).alias("_m2"),
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    sd = F.sqrt(F.greatest(F.col("_m2") - F.col("_mu") * F.col("_mu"), F.lit(0.0)))
    ks_w = ks_w.select("column", "ks", (F.col("wasserstein") / F.when(sd > 0, sd)).alias("wasserstein_norm"),
                       ks_pvalue(F.col("ks"), F.col("n_ref"), F.col("n_cur")).alias("ks_pvalue"),
                       "n_ref", "n_cur")
    binned = _binned_divergences(ref, cur, columns, bins)
    return ks_w.join(binned, "column", "left")


def _binned_divergences(ref: DataFrame, cur: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """PSI and JS distance over bins cut at the reference deciles (exact
    percentiles of the reference, one aggregate)."""
    qs = [i / bins for i in range(1, bins)]
    edges_row = quantiles(ref, columns, qs)

    def binned(df, pop):
        parts = []
        for c in columns:
            edges = sorted(set(edges_row[c] or []))
            b = sum((F.when(F.col(c) > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
            parts.append(F.struct(F.lit(c).alias("column"), F.when(F.col(c).isNotNull(), b).alias("bin")))
        return (df.select(F.explode(F.array(*parts)).alias("kv")).select("kv.column", "kv.bin")
                .where(F.col("bin").isNotNull()).withColumn("pop", F.lit(pop)))
    u = binned(ref, "ref").unionByName(binned(cur, "cur"))
    return _divergences(u.groupBy("column", "bin").agg(F.count_if(F.col("pop") == "ref").alias("n_ref"),
                                                       F.count_if(F.col("pop") == "cur").alias("n_cur")), "bin")


def _divergences(counts: DataFrame, cell: str) -> DataFrame:
    """PSI, JS distance (natural log) and χ² over per-cell counts."""
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"))
    p = counts.join(F.broadcast(totals), "column").select(
        "column", cell, (F.col("n_ref") / F.col("tot_ref")).alias("p"), (F.col("n_cur") / F.col("tot_cur")).alias("q"),
        "n_ref", "n_cur", "tot_cur")
    pe = F.greatest(F.col("p"), F.lit(PSI_EPS))
    qe = F.greatest(F.col("q"), F.lit(PSI_EPS))
    m = (F.col("p") + F.col("q")) / 2

    def kl(a):
        return F.when(a > 0, a * F.log(a / m)).otherwise(F.lit(0.0))
    expected = F.col("p") * F.col("tot_cur")
    return p.groupBy("column").agg(
        F.sum((qe - pe) * F.log(qe / pe)).alias("psi"),
        F.sqrt(F.greatest(F.sum(kl(F.col("p")) + kl(F.col("q"))) / 2, F.lit(0.0))).alias("js"),
        F.sum(F.when(expected > 0, (F.col("n_cur") - expected) ** 2 / expected).otherwise(0.0)).alias("chi2"),
        (F.count_if(F.col("n_ref") > 0) - 1).alias("chi2_dof"))


def categorical_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D03 categorical: JS distance, PSI and χ² (statistic over the reference
    categories, with its p-value) over category shares."""
    counts = _long(ref, cur, columns, "cat")
    d = _divergences(counts.withColumnRenamed("value", "category"), "category")
    return d.withColumn("chi2_pvalue", chi2_pvalue(F.col("chi2"), F.col("chi2_dof").cast("double")))


def drift_report(ref: DataFrame, cur: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
                 stat: str = "js", threshold: float = 0.1) -> DataFrame:
    """One row per column with its statistics and the drift flag
    (``stat`` above ``threshold``; the published rule is JS > 0.1)."""
    parts = []
    if numeric:
        n = numeric_drift(ref, cur, numeric)
        parts.append(n.select("column", F.lit("numerical").alias("kind"), "ks", "wasserstein_norm", "psi", "js", "chi2"))
    if categorical:
        c = categorical_drift(ref, cur, categorical)
        parts.append(c.select("column", F.lit("categorical").alias("kind"), F.lit(None).cast("double").alias("ks"),
                              F.lit(None).cast("double").alias("wasserstein_norm"), "psi", "js", "chi2"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("drifted", F.col(stat) > F.lit(threshold))


def dataset_drift(report: DataFrame, share: float = 0.5, n_ref: int | None = None,
                  n_cur: int | None = None) -> DataFrame:
    """Number and share of drifted columns, flag when share ≥ ``share``."""
    s = report.agg(F.count_if("drifted").alias("drifted_columns"), F.count(F.lit(1)).alias("total_columns"))
    s = s.withColumn("drift_share", F.col("drifted_columns") / F.col("total_columns"))
    s = s.withColumn("dataset_drift", F.col("drift_share") >= F.lit(share))
    if n_ref is not None:
        s = s.withColumn("n_reference", F.lit(n_ref))
    if n_cur is not None:
        s = s.withColumn("n_current", F.lit(n_cur))
    return s


def drift_alerts(report: DataFrame, stat: str = "js", threshold: float = 0.1) -> DataFrame:
    """One alert row (type, score, threshold, affected features, status)
    when any column drifted. ``collect_list`` is bounded by the column count."""
    d = report.where(F.col(stat) > F.lit(threshold))
    return d.agg(F.lit("data_drift").alias("alert_type"), F.max(stat).alias("score"),
                 F.lit(float(threshold)).alias("threshold"),
                 F.array_sort(F.collect_list("column")).alias("affected_features"),
                 F.lit("open").alias("status")).where(F.size("affected_features") > 0)


# D05 / D07 -----------------------------------------------------------------------------
def quality_summary(df: DataFrame, columns: Sequence[str], population: str) -> DataFrame:
    """Missing count, distinct count, min and max per column (one aggregate,
    and a distinct count per column joined to its one row per column)."""
    from credal.operators.profile import distinct_count_table
    exprs = []
    for c in columns:
        exprs += [F.count_if(F.col(c).isNull()).alias(f"{c}__miss"),
                  F.min(F.col(c).cast("double")).alias(f"{c}__min"), F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    stack = ", ".join(f"'{c}', `{c}__miss`, `{c}__min`, `{c}__max`" for c in columns)
    return (df.agg(*exprs).selectExpr(f"stack({len(columns)}, {stack}) AS (column, missing, min, max)")
            .join(distinct_count_table(df, columns), "column")
            .select("column", "missing", "distinct_count", "min", "max", F.lit(population).alias("population")))


def metric_rows(metrics: DataFrame, metric_type: str = "reference", id_cols: Sequence[str] = ()) -> DataFrame:
    """A wide metrics row → (name, value, type) rows, ready to append."""
    value_cols = [c for c in metrics.columns if c not in id_cols]
    long = metrics.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in value_cols]).unpivot(
        list(id_cols), value_cols, "metric_name", "metric_value")
    return long.withColumn("metric_type", F.lit(metric_type))


def model_performance(versions: DataFrame, requests: DataFrame, results: DataFrame) -> DataFrame:
    """Versions ⟕ requests ⟕ results, then per version: requests,
    mean confidence, mean latency, successful results."""
    j = (versions.join(requests, "model_version_id", "left")
         .join(results, "request_id", "left"))
    return j.groupBy("model_version_id", "model_name").agg(
        F.count("request_id").alias("requests"), F.avg("confidence").alias("avg_confidence"),
        F.avg("latency_ms").alias("avg_latency_ms"), F.count_if(F.col("success")).alias("successes"))
