"""Structured Streaming: late data beyond the watermark, duplicates, batch = stream."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from credal.sources import io
from credal.streaming import log_stream as S

SCHEMA = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("request_id", T.LongType()),
                       T.StructField("probability", T.DoubleType()), T.StructField("latency_ms", T.DoubleType()),
                       T.StructField("channel", T.StringType()), T.StructField("value", T.DoubleType())])


def _write(spark, base, rows):
    df = spark.createDataFrame(rows, "ts string, request_id long, probability double").select(
        F.to_timestamp_ntz(F.col("ts")).alias("ts"), "request_id", "probability",
        F.lit(1.0).alias("latency_ms"), F.lit("web").alias("channel"), F.lit(0.0).alias("value"))
    io.append_jsonl(df.coalesce(1), f"{base}/log")


def test_out_of_order_events_within_watermark_update_their_window(spark):
    """Rows arriving out of order but within the 2-hour delay are counted in
    their (earlier) window: the update-mode upserts give the final counts."""
    base = io.scratch_dir(spark, "late")
    _write(spark, base, [("2024-01-01 10:05:00", 1, 0.05), ("2024-01-01 10:10:00", 2, 0.5)])
    _write(spark, base, [("2024-01-01 11:30:00", 3, 0.5)])
    _write(spark, base, [("2024-01-01 10:20:00", 4, 0.5), ("2024-01-01 11:40:00", 5, 0.05)])  # 10:20 arrives late
    stream = S.with_decision(S.read_log_stream(spark, f"{base}/log", SCHEMA, max_files_per_trigger=1), 0.1)
    agg = S.hourly_decisions(stream, watermark="2 hours")
    S.run_to_table(agg.select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "decision", "n"),
                   f"{base}/out", f"{base}/ckpt", mode="update")
    got = {(str(r.hour), r.decision): r.n for r in S.latest_per_key(spark.read.parquet(f"{base}/out"),
                                                                     ["hour", "decision"]).collect()}
    assert got == {("2024-01-01 10:00:00", "approved"): 1, ("2024-01-01 10:00:00", "refused"): 2,
                   ("2024-01-01 11:00:00", "refused"): 1, ("2024-01-01 11:00:00", "approved"): 1}


def test_duplicates_removed_within_watermark(spark):
    base = io.scratch_dir(spark, "dups")
    _write(spark, base, [("2024-01-01 10:00:00", 1, 0.1), ("2024-01-01 10:01:00", 2, 0.2)])
    _write(spark, base, [("2024-01-01 10:00:00", 1, 0.1), ("2024-01-01 11:00:00", 3, 0.3)])
    d = S.deduplicate(S.read_log_stream(spark, f"{base}/log", SCHEMA, max_files_per_trigger=1), watermark="1 day")
    S.run_to_table(d.select("request_id"), f"{base}/out", f"{base}/ckpt")
    assert sorted(r.request_id for r in spark.read.parquet(f"{base}/out").collect()) == [1, 2, 3]
