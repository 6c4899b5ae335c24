"""Demo queries: sources and sinks. Each job writes the given tables (as raw
files, logs or exports) under the shared checkpoint folder, reads them back
through the library's readers and returns what it read."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from credal.operators import preprocess as P
from credal.operators import profile as Q
from credal.plans.catalog import register, rounded, table
from credal.plans.customer_features import customer_features
from credal.plans.demo_features import CUSTOMER_FEATURES_SQL
from credal.plans.demo_preprocess import FIT_TRANSFORM_SQL, SPEC, matrix_standin
from credal.sources import io

RAW_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("C_CUSTKEY", T.LongType()), T.StructField("C_NAME", T.StringType()),
    T.StructField("C_NATIONKEY", T.IntegerType()), T.StructField("C_ACCTBAL", T.DoubleType()),
    T.StructField("C_MKTSEGMENT", T.StringType())])

INGEST_SQL = "SELECT c_custkey AS sk_id_curr, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@register("source_csv_ingest", "S01,S02,S03,S04", INGEST_SQL)
def q_ingest(spark, sf_dir):
    """Raw CSV files (upper-case headers) ingested with an explicit schema,
    renamed by the registry map, lower-cased, stored as parquet; a missing
    file is skipped."""
    base = io.scratch_dir(spark, "ingest")
    c = table(spark, sf_dir, "customer")
    raw = c.toDF(*[n.upper() for n in c.columns])
    io.write_table(raw, f"{base}/raw/customer.csv", fmt="csv", options={"header": "true"})
    tables, _report = io.ingest_all(
        spark, {"customer": f"{base}/raw/customer.csv", "bureau": f"{base}/raw/absent.csv"},
        schemas={"customer": RAW_CUSTOMER_SCHEMA}, renames={"customer": {"C_CUSTKEY": "SK_ID_CURR"}},
        out_dir=f"{base}/parquet")
    return tables["customer"]


@register("source_ingest_report", "S02,S06")
def q_ingest_report(spark, sf_dir):
    """Per-table ingest report (loaded / missing, rows, columns)."""
    base = io.scratch_dir(spark, "ingest")
    for name in ("customer", "nation"):
        io.write_table(table(spark, sf_dir, name), f"{base}/raw/{name}.csv", fmt="csv", options={"header": "true"})
    _, report = io.ingest_all(spark, {"customer": f"{base}/raw/customer.csv", "nation": f"{base}/raw/nation.csv",
                                      "bureau": f"{base}/raw/bureau.csv"})
    return report


EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


@register("source_jsonl_log", "S10,S11", EVENTS_SQL)
def q_jsonl(spark, sf_dir):
    """JSON Lines log appended in two writes plus a corrupt file; read back with
    an explicit schema, corrupt and blank lines dropped (and countable)."""
    base = io.scratch_dir(spark, "log")
    e = table(spark, sf_dir, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    io.append_jsonl(e.where(F.col("ts") < cut), base)
    io.append_jsonl(e.where(F.col("ts") >= cut), base)
    spark.createDataFrame([('{"event_id": 1, "ts": ',), ("",), ("not json",)], "line string") \
        .write.mode("append").text(base)
    good, _bad = io.read_jsonl(spark, base, EVENT_SCHEMA)
    return good


@register("source_reference_sample", "S12")
def q_sample(spark, sf_dir):
    """min(100, rows) customers chosen by a seeded key hash (same on any
    partitioning), exported to a file and read back."""
    path = io.scratch_dir(spark, "reference-sample")
    sample = io.reference_sample(table(spark, sf_dir, "customer"), 100, ["c_custkey"], seed=42)
    io.write_table(sample, path)
    return spark.read.parquet(path)


SPLIT_SQL = "SELECT c_custkey, c_acctbal, 'test' AS split FROM customer WHERE c_mktsegment = 'BUILDING'"


@register("source_split_partitioned", "S15,S05", SPLIT_SQL)
def q_split_write(spark, sf_dir):
    """Train/test written as one table partitioned by split; the test split read
    back prunes the train partition."""
    base = io.scratch_dir(spark, "splits")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", F.when(F.col("c_mktsegment") == "BUILDING", "test").otherwise("train").alias("split"))
    io.write_splits(c, base)
    return io.load_split(spark.read.parquet(base), "test").select("c_custkey", "c_acctbal", "split")


SCORES_SQL = "SELECT c_custkey, round(c_acctbal / 10000.0, 6) AS score FROM customer"


@register("source_score_export", "S16,S07", SCORES_SQL)
def q_scores(spark, sf_dir):
    """Two-column id + score CSV export (folder named with the shape), read back."""
    base = io.scratch_dir(spark, "scores")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.round(F.col("c_acctbal") / 10000.0, 6).alias("score"))
    path = io.export_delimited(c, base, "scores")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("score", T.DoubleType())])
    return io.read_csv(spark, path, schema)


@register("source_params_store", "S14,E20", FIT_TRANSFORM_SQL)
def q_params(spark, sf_dir):
    """Fit → save the parameters as JSON → load → transform: identical output."""
    m = matrix_standin(spark, sf_dir)
    params = P.fit(m.where("is_train"), SPEC)
    path = io.save_json_params(spark, params.to_json(), io.scratch_dir(spark, "params"))
    loaded = P.Params.from_json(io.load_json_params(spark, path))
    return rounded(P.transform(m, loaded, keep=["l_orderkey", "l_linenumber"]))


@register("source_parquet_cache", "S09", CUSTOMER_FEATURES_SQL)
def q_cache(spark, sf_dir):
    """Feature table built once, written as parquet, later reads from the files."""
    path = io.scratch_dir(spark, "features")
    build = lambda: rounded(customer_features(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"),
                                              table(spark, sf_dir, "lineitem")))
    io.parquet_cache(spark, path, build)
    return io.parquet_cache(spark, path, build)


@register("source_catalog_listing", "S06")
def q_catalog(spark, sf_dir):
    """Catalog listing of registered views and their lower-cased columns."""
    table(spark, sf_dir, "customer").createOrReplaceTempView("credal_customer")
    table(spark, sf_dir, "orders").createOrReplaceTempView("credal_orders")
    listing = io.catalog_listing(spark).where(F.col("name").startswith("credal_"))
    cols = [(n, c) for n in ("credal_customer", "credal_orders", "credal_absent") for c in io.table_columns(spark, n)]
    colsdf = spark.createDataFrame(cols, "name string, column string")
    return listing.join(colsdf, "name", "left")


REGISTRY_SQL = """
WITH a AS (SELECT count(*) AS n, count(DISTINCT c_mktsegment) AS dm, count(DISTINCT c_name) AS dx,
                  list_sort(list(DISTINCT c_mktsegment)) AS ms, list_sort(list(DISTINCT c_name)) AS xs FROM customer),
maps AS (SELECT '{' || array_to_string(list_transform(ms, lambda v: '''' || v || ''': ''' || lower(v) || ''''), ', ') || '}' AS m,
                '{' || array_to_string(list_transform(xs, lambda v: '''' || v || ''': '''
                       || regexp_replace(lower(v), '[^a-z0-9]+', '_', 'g') || ''''), ', ') || '}' AS x FROM a),
r AS (
  SELECT 'c_custkey' AS name, 'identifier' AS type, 'identifier' AS role, 'none' AS encoding, 'none' AS transform,
         NULL AS value_map, (SELECT count(*) FROM customer WHERE c_custkey IS NULL) AS z
  UNION ALL SELECT 'c_name', 'categorical', 'feature', CASE WHEN dx <= 15 THEN 'one_hot' WHEN dx < 50 THEN 'ordinal' ELSE 'target' END,
         'none', CASE WHEN dx <= 15 THEN maps.x END, (SELECT count(*) FROM customer WHERE c_name IS NULL) FROM a, maps
  UNION ALL SELECT 'c_nationkey', 'numerical', 'feature', 'none', 'standard', NULL,
         (SELECT count(*) FROM customer WHERE c_nationkey IS NULL)
  UNION ALL SELECT 'c_acctbal', 'numerical', 'feature', 'none', 'standard', NULL,
         (SELECT count(*) FROM customer WHERE c_acctbal IS NULL)
  UNION ALL SELECT 'c_mktsegment', 'categorical', 'feature',
         CASE WHEN dm <= 15 THEN 'one_hot' WHEN dm < 50 THEN 'ordinal' ELSE 'target' END, 'none',
         CASE WHEN dm <= 15 THEN maps.m END, (SELECT count(*) FROM customer WHERE c_mktsegment IS NULL) FROM a, maps)
SELECT name, 'customer' AS source_table, type, role, encoding, transform, name AS raw_name, value_map,
       z * 100.0 / n AS null_pct, z * 100.0 / n >= 30 AS null_alert
FROM r, a
"""


@register("source_registry_roundtrip", "S13,Q09", REGISTRY_SQL)
def q_registry(spark, sf_dir):
    """Registry inferred from a table, exported as JSON Lines, read back."""
    c = table(spark, sf_dir, "customer")
    reg = Q.infer_registry(c, "customer", id_columns=["c_custkey"])
    path = io.scratch_dir(spark, "registry")
    reg.write.mode("overwrite").json(path)
    return spark.read.schema(reg.schema).json(path)


CHUNKED_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@register("export_replace_then_append", "S08,S04", CHUNKED_SQL)
def q_chunked(spark, sf_dir):
    """The first part replaces the table, later parts append (each write is
    distributed; there is no 10,000-row chunk loop)."""
    path = io.scratch_dir(spark, "export")
    c = table(spark, sf_dir, "customer")
    io.write_table(c.where(F.col("c_nationkey") < 12), path, mode="overwrite")
    io.write_table(c.where(F.col("c_nationkey") >= 12), path, mode="append")
    return spark.read.parquet(path)


XY_SQL = """
SELECT o.o_custkey AS c_custkey, count(*) AS n_orders, round(avg(o_totalprice), 6) AS mean_price,
       CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS y
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY o.o_custkey, c.c_acctbal
"""


@register("features_labels_by_key", "J05,E20", XY_SQL)
def q_xy(spark, sf_dir):
    """Features and labels kept together by joining on the key (row positions
    carry no meaning in Spark)."""
    from credal.operators.assemble import align_by_key
    x = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.avg("o_totalprice").alias("mean_price"))
    y = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("y"))
    return rounded(align_by_key(x, y, "c_custkey"))
