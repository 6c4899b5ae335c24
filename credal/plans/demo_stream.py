"""Demo queries: Structured Streaming over the prediction log.

The events table is appended to a JSON Lines log folder (first half, second
half, and for T04 the last two days again) under the shared checkpoint folder.
After each append the streaming query runs to completion (``availableNow``) over
what is new, from its checkpoint; the job returns what the sink holds.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from credal.operators import linear as LM
from credal.operators import train as TR
from credal.operators.linear import LinearModel, Term
from credal.plans.catalog import register, rounded, table
from credal.sources import io
from credal.streaming import log_stream as S

THRESHOLD = 0.1
LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampNTZType()), T.StructField("request_id", T.LongType()),
    T.StructField("probability", T.DoubleType()), T.StructField("latency_ms", T.DoubleType()),
    T.StructField("channel", T.StringType()), T.StructField("value", T.DoubleType())])


def append_and_run(spark, sf_dir, run, duplicates: bool = False) -> str:
    """The events arrive as 2 (or 3) appends to a prediction log; after each one
    ``run(base)`` takes what is new as one micro-batch, going on from its
    checkpoint. An append is many files, ranges of the event time."""
    base = io.scratch_dir(spark, "stream-log")
    e = table(spark, sf_dir, "events").select(
        "ts", F.col("event_id").alias("request_id"), (F.col("value") / 500.0).alias("probability"),
        F.get_json_object("props", "$.k").cast("double").alias("latency_ms"), F.col("event_type").alias("channel"),
        "value")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    appends = [e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)]
    if duplicates:
        appends.append(e.where(F.col("ts") >= F.lit("2024-01-29").cast("timestamp_ntz")))
    for part in appends:
        io.append_jsonl(part.repartitionByRange("ts"), f"{base}/log")
        run(base)
    return base


HOURLY_SQL = f"""
SELECT date_trunc('hour', ts) AS hour,
       CASE WHEN value / 500.0 < 0 OR value / 500.0 > 1 THEN NULL
            WHEN value / 500.0 < {THRESHOLD} THEN 'approved' ELSE 'refused' END AS decision, count(*) AS n
FROM events GROUP BY 1, 2
"""


@register("stream_hourly_decisions", "T01,T02,A13", HOURLY_SQL)
def q_stream_hourly(spark, sf_dir):
    """Tumbling hourly decision counts with a 2-hour watermark (update mode,
    batch-id upserts); equals the batch hourly counts on in-order input."""
    def run(base):
        stream = S.with_decision(S.read_log_stream(spark, f"{base}/log", LOG_SCHEMA), THRESHOLD)
        agg = S.hourly_decisions(stream, watermark="2 hours")
        S.run_to_table(agg.select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "decision", "n"),
                       f"{base}/out", f"{base}/ckpt", mode="update")

    base = append_and_run(spark, sf_dir, run)
    return S.latest_per_key(spark.read.parquet(f"{base}/out"), ["hour", "decision"])


DEDUP_SQL = "SELECT event_id AS request_id, ts, event_type AS channel FROM events"


@register("stream_dedup", "T04,T01", DEDUP_SQL)
def q_stream_dedup(spark, sf_dir):
    """Re-sent requests (the last two days twice) removed within the watermark."""
    def run(base):
        stream = S.read_log_stream(spark, f"{base}/log", LOG_SCHEMA)
        d = S.deduplicate(stream, ["request_id"], watermark="3 days").select(
            "request_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "channel")
        S.run_to_table(d, f"{base}/out", f"{base}/ckpt", mode="append")

    base = append_and_run(spark, sf_dir, run, duplicates=True)
    return spark.read.parquet(f"{base}/out")


@register("stream_window_indicators", "T03")
def q_stream_kpi(spark, sf_dir):
    """Daily windows: totals, refusals, refusal rate, mean probability, approx p95 latency."""
    def run(base):
        stream = S.with_decision(S.read_log_stream(spark, f"{base}/log", LOG_SCHEMA), THRESHOLD)
        agg = S.windowed_indicators(stream, window="1 day", watermark="2 hours")
        S.run_to_table(agg.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "total", "refusals", "refusal_rate",
                                  "mean_probability", "latency_p95_approx"), f"{base}/out", f"{base}/ckpt", mode="update")

    base = append_and_run(spark, sf_dir, run)
    return rounded(S.latest_per_key(spark.read.parquet(f"{base}/out"), ["day"]))


@register("stream_scoring", "T05,M17")
def q_stream_score(spark, sf_dir):
    """A model fitted on the batch log scores every arriving request; the
    scored rows are appended to a JSON Lines sink."""
    events = table(spark, sf_dir, "events").select(
        F.get_json_object("props", "$.k").cast("double").alias("latency_ms"), "value",
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label"))
    model = TR.fit_model(events, ["latency_ms", "value"],
                         TR.model_catalogue(TR.weighted_rows(events), "label", None)["logistic"])

    def run(base):
        stream = S.read_log_stream(spark, f"{base}/log", LOG_SCHEMA).drop("probability")
        scored = TR.score(stream, model, THRESHOLD, keep=["request_id", "ts"])
        S.run_to_jsonl(scored, f"{base}/scored", f"{base}/ckpt")

    base = append_and_run(spark, sf_dir, run)
    return spark.read.schema("request_id long, ts timestamp_ntz, probability double, decision string") \
        .json(f"{base}/scored")


HOURLY_KPI_SQL = f"""
WITH lg AS (
  SELECT ts, value / 500.0 AS probability,
         CASE WHEN value / 500.0 < 0 OR value / 500.0 > 1 THEN NULL
              WHEN value / 500.0 < {THRESHOLD} THEN 'approved' ELSE 'refused' END AS decision
  FROM events)
SELECT date_trunc('hour', ts) AS hour, count(*) AS total, count(*) FILTER (WHERE decision = 'refused') AS refusals,
       round(avg(probability), 6) AS mean_probability,
       round(CAST(count(*) FILTER (WHERE decision = 'refused') AS DOUBLE) / count(*), 6) AS refusal_rate
FROM lg GROUP BY 1
"""


@register("stream_hourly_indicators", "T03,T01,D01", HOURLY_KPI_SQL)
def q_stream_hourly_kpi(spark, sf_dir):
    """Hourly windows on the log stream: totals, refusals, refusal rate and mean
    probability (exact; equals the batch indicators per hour)."""
    def run(base):
        stream = S.with_decision(S.read_log_stream(spark, f"{base}/log", LOG_SCHEMA), THRESHOLD)
        agg = S.windowed_indicators(stream, window="1 hour", watermark="2 hours", latency=None)
        S.run_to_table(agg.select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "total", "refusals",
                                  "mean_probability", "refusal_rate"), f"{base}/out", f"{base}/ckpt", mode="update")

    base = append_and_run(spark, sf_dir, run)
    return rounded(S.latest_per_key(spark.read.parquet(f"{base}/out"), ["hour"]))


WINDOW_PERCENTILES_SQL = """
SELECT date_trunc('day', ts) AS day, count(*) AS n,
       round(quantile_cont(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.95), 6) AS p95,
       round(quantile_cont(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.99), 6) AS p99
FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL
GROUP BY 1
HAVING date_trunc('day', any_value(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)
"""


@register("stream_window_percentiles", "T03,A14", WINDOW_PERCENTILES_SQL)
def q_stream_percentiles(spark, sf_dir):
    """Daily windows closed by the watermark: rows and exact latency p50, p95, p99."""
    def run(base):
        stream = S.read_log_stream(spark, f"{base}/log", LOG_SCHEMA)
        counts = S.windowed_value_counts(stream, "latency_ms", window="1 day", watermark="2 hours")
        S.run_to_table(counts.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "latency_ms", "n"),
                       f"{base}/out", f"{base}/ckpt")

    base = append_and_run(spark, sf_dir, run)
    counts = spark.read.parquet(f"{base}/out")
    found = S.closed_window_percentiles(counts, "day", "latency_ms", [0.5, 0.95, 0.99])
    return rounded(found.join(counts.groupBy("day").agg(F.sum("n").alias("n")), "day"))


STREAM_MODEL = LinearModel(-2.2, (Term("latency_ms", "latency_ms", 0.0125), Term("value", "value", 0.0075)))

STORED_STREAM_SQL = f"""
WITH p AS (SELECT event_id AS request_id, ts,
                  1.0 / (1.0 + exp(-(-2.2 + 0.0125 * CAST(json_extract_string(props, '$.k') AS DOUBLE) + 0.0075 * value))) AS p
           FROM events)
SELECT request_id, ts, round(p, 6) AS probability,
       CASE WHEN p IS NULL THEN NULL WHEN p < {THRESHOLD} THEN 'approved' ELSE 'refused' END AS decision
FROM p
"""


@register("stream_stored_model", "T05,M17,C29", STORED_STREAM_SQL)
def q_stream_stored(spark, sf_dir):
    """A saved scoring model, read back from its table, scores every arriving request
    in one select; scores are appended to a JSON Lines sink."""
    model = LinearModel.load(spark, STREAM_MODEL.save(spark, io.scratch_dir(spark, "scoring-model")))

    def run(base):
        stream = S.read_log_stream(spark, f"{base}/log", LOG_SCHEMA).drop("probability")
        S.run_to_jsonl(LM.score(stream, model, THRESHOLD, keep=["request_id", "ts"]), f"{base}/scored", f"{base}/ckpt")

    base = append_and_run(spark, sf_dir, run)
    return rounded(spark.read.schema("request_id long, ts timestamp_ntz, probability double, decision string")
                   .json(f"{base}/scored"))
