"""Sources and sinks: ingest report, missing files, header rename, parquet cache, params store."""

from pyspark.sql import types as T

from credal.sources import io


def test_ingest_all_skips_missing_and_renames(spark):
    base = io.scratch_dir(spark, "ingest-test")
    raw = spark.createDataFrame([(1, " A ", 2.5), (2, "B", None)], "SK_ID_CURR long, NAME string, AMT double")
    io.write_table(raw, f"{base}/a.csv", fmt="csv", options={"header": "true"})
    schema = T.StructType([T.StructField("SK_ID_CURR", T.LongType()), T.StructField("NAME", T.StringType()),
                           T.StructField("AMT", T.DoubleType())])
    tables, report = io.ingest_all(spark, {"a": f"{base}/a.csv", "b": f"{base}/missing.csv"},
                                   schemas={"a": schema}, renames={"a": {"AMT": "AMT_TOTAL"}}, out_dir=f"{base}/pq")
    rep = {r.table: (r.status, r.rows, r.columns) for r in report.collect()}
    assert rep == {"a": ("loaded", 2, 3), "b": ("missing", None, None)}
    assert {r.table: r.malformed for r in report.collect()} == {"a": 0, "b": None}
    assert tables["a"].columns == ["sk_id_curr", "name", "amt_total"]
    assert set(tables) == {"a"}


def test_parquet_cache_builds_once(spark):
    path = io.scratch_dir(spark, "cache-test")
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1,)], "x int")
    assert io.parquet_cache(spark, path, build).count() == 1
    assert io.parquet_cache(spark, path, build).count() == 1
    assert len(calls) == 1


def test_malformed_rows_are_quarantined_and_counted(spark):
    base = io.scratch_dir(spark, "malformed-test")
    spark.createDataFrame([("id,amt",), ("1,2.5",), ("x,3.0",), ("2,oops",), ("3,",), (",4",)], "value string") \
        .coalesce(1).write.text(f"{base}/t.csv")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amt", T.DoubleType())])
    for out_dir in (None, f"{base}/pq"):
        tables, report = io.ingest_all(spark, {"t": f"{base}/t.csv"}, schemas={"t": schema}, out_dir=out_dir)
        r = report.first()
        assert (r.rows, r.malformed) == (3, 2)
        assert tables["t"].count() == 3 and tables["t"].select("amt").count() == 3
        assert {(x.id, x.amt) for x in tables["t"].collect()} == {(1, 2.5), (3, None), (None, 4.0)}
    assert spark.read.parquet(f"{base}/pq/_malformed/t").count() == 2


def test_parquet_cache_rebuilds_a_half_written_folder(spark):
    path = io.scratch_dir(spark, "half-test")
    spark.createDataFrame([(1,)], "x int").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .parquet(path)
    assert io.parquet_cache(spark, path, lambda: spark.createDataFrame([(1,), (2,)], "x int")).count() == 2


def test_params_store_roundtrip(spark):
    path = io.scratch_dir(spark, "params-test")
    text = '{"a": [1, 2], "b": "x"}'
    io.save_json_params(spark, text, path)
    assert io.load_json_params(spark, path) == text
