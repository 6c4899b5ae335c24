"""Structured Streaming over the prediction log.

The log is an append-only folder of JSON Lines files. The streaming jobs
read it with an explicit schema (no inference), bound their state with an
event-time watermark, and write idempotently: every micro-batch of an
``update``-mode aggregate is appended with its batch id, and the current
value of a window is the row of its latest batch (:func:`latest_per_key`).
Checkpoints live under the cluster's shared checkpoint folder, so a restarted
query resumes where it stopped after losing executors or the driver. The
number of state partitions is fixed by ``spark.sql.shuffle.partitions`` when
a query first starts (it is stored in the checkpoint): size it for the state
the watermark keeps, not for the test data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credal.functions import clean as C
from credal.operators.quantiles import quantiles_of_counts
from credal.sources.io import CORRUPT

LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("request_id", T.LongType(), True),
    T.StructField("probability", T.DoubleType(), True),
    T.StructField("latency_ms", T.DoubleType(), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])


# T01 ------------------------------------------------------------------------------
def read_log_stream(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """File source over the JSON Lines folder. Malformed lines are left out
    and counted: every batch reports ``lines`` and ``malformed`` under
    ``log_lines`` of its progress (``observedMetrics``)."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = r.text(path).where(F.trim("value") != "").select(F.from_json("value", full, opts).alias("j")).select("j.*")
    rows = rows.observe("log_lines", F.count(F.lit(1)).alias("lines"), F.count(CORRUPT).alias("malformed"))
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


# T02 / T03 / T04 --------------------------------------------------------------------
def _event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a TIMESTAMP column; a TIMESTAMP_NTZ log time is read as
    a UTC wall-clock time (the session time zone is UTC)."""
    if dict(stream.dtypes).get(ts) == "timestamp_ntz":
        return stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream


def hourly_decisions(stream: DataFrame, ts: str = "ts", decision: str = "decision",
                     watermark: str = "2 hours") -> DataFrame:
    """Tumbling one-hour windows × decision, bounded by a watermark."""
    return (_event_time(stream, ts).withWatermark(ts, watermark)
            .groupBy(F.window(F.col(ts), "1 hour").alias("w"), F.col(decision))
            .agg(F.count(F.lit(1)).alias("n")))


def windowed_indicators(stream: DataFrame, ts: str = "ts", window: str = "1 day", watermark: str = "2 hours",
                        decision: str = "decision", probability: str = "probability",
                        latency: str | None = "latency_ms") -> DataFrame:
    """Per event-time window: totals, refusals, refusal rate, mean
    probability and (when ``latency`` is given) the approximate latency p95
    (a bounded-memory sketch; exact percentiles would keep every value in
    the window's state)."""
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(F.col(decision) == C.REFUSED).alias("refusals"),
            F.avg(probability).alias("mean_probability")]
    if latency:
        aggs.append(F.percentile_approx(F.col(latency), 0.95, 10000).alias("latency_p95_approx"))
    return (_event_time(stream, ts).withWatermark(ts, watermark)
            .groupBy(F.window(F.col(ts), window).alias("w")).agg(*aggs)
            .withColumn("refusal_rate", F.col("refusals") / F.col("total")))


def windowed_value_counts(stream: DataFrame, value: str, ts: str = "ts", window: str = "1 day",
                          watermark: str = "2 hours") -> DataFrame:
    """T03, exact percentiles, the streaming half: ``(w, value, n)`` for appending,
    each row written once, when the watermark passes the window's end. The state is a
    count per (open window, value), dealt out by both, so no task holds a window;
    null values take no part, rows later than the watermark are dropped."""
    rows = _event_time(stream, ts).where(F.col(value).isNotNull()).withWatermark(ts, watermark)
    return rows.groupBy(F.window(F.col(ts), window).alias("w"), F.col(value)).agg(F.count(F.lit(1)).alias("n"))


def closed_window_percentiles(counts: DataFrame, key: str, value: str, probs: Sequence[float],
                              names: Sequence[str] | None = None) -> DataFrame:
    """T03, the reading half: exact interpolated percentiles of every closed window
    from the counts that :func:`windowed_value_counts` appended, by bucketed running
    sums. A window is whole or absent, for its counts leave the state in one batch."""
    return quantiles_of_counts(counts, [key], value, "n", probs, names)


def deduplicate(stream: DataFrame, key: Sequence[str] = ("request_id",), ts: str = "ts",
                watermark: str = "1 day") -> DataFrame:
    """One row per request id; state kept only within the watermark."""
    return _event_time(stream, ts).withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(key))


# T05 --------------------------------------------------------------------------------
def with_decision(stream: DataFrame, threshold: float, probability: str = "probability") -> DataFrame:
    """C29 on a stream (the batch and streaming rule are the same expression)."""
    return stream.withColumn("decision", C.decision(probability, threshold))


# sinks ------------------------------------------------------------------------------
def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append",
                 batch_id_col: str | None = None) -> None:
    """Run the query over everything available (``availableNow``), writing
    parquet. In ``update`` mode each micro-batch is appended with its batch
    id (``foreachBatch``), which makes a re-run after a failure idempotent
    per batch id."""
    if mode == "update":
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn(batch_id_col or "batch_id", F.lit(batch_id)).write.mode("append").parquet(path)
        q = (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(write).trigger(availableNow=True).start())
    else:
        q = (stream.writeStream.outputMode(mode).format("parquet").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_per_key(df: DataFrame, keys: Sequence[str], batch_col: str = "batch_id") -> DataFrame:
    """Current value of every key from an update-mode log: the row of the
    highest batch id (a partial ``max_by`` aggregate, not a window)."""
    cols = [c for c in df.columns if c not in keys and c != batch_col]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(batch_col))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def run_to_jsonl(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available to a JSON Lines sink; times keep their microseconds."""
    (stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .trigger(availableNow=True).start().awaitTermination())
