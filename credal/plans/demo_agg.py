"""Demo queries: aggregations, joins, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from credal.functions import clean as C
from credal.operators import aggregate as A
from credal.operators import assemble as J
from credal.operators.sphere import sphere_neighbour_counts
from credal.plans.catalog import register, rounded, sround, table

SPEC_SQL = f"""
WITH o AS (SELECT o_custkey, o_totalprice / 7001.0 AS price_k, o_orderpriority, o_orderkey FROM orders)
SELECT o_custkey, {sround("min(price_k)")} AS "ORD_PRICE_K_MIN", {sround("max(price_k)")} AS "ORD_PRICE_K_MAX",
       {sround("avg(price_k)")} AS "ORD_PRICE_K_MEAN", {sround("var_samp(price_k)")} AS "ORD_PRICE_K_VAR",
       {sround("sum(price_k)")} AS "ORD_PRICE_K_SUM", count(DISTINCT o_orderpriority) AS "ORD_O_ORDERPRIORITY_NUNIQUE",
       count(*) AS "ORD_O_ORDERKEY_SIZE"
FROM o GROUP BY o_custkey
"""


@register("agg_spec_driven", "A06", SPEC_SQL)
def q_spec(spark, sf_dir):
    """{column: [min, max, mean, var, sum, nunique, size]} → PREFIX_COLUMN_FUNC per customer."""
    o = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_totalprice") / 7001.0).alias("price_k"),
                                              "o_orderpriority", "o_orderkey")
    spec = {"price_k": ["min", "max", "mean", "var", "sum"], "o_orderpriority": ["nunique"], "o_orderkey": ["size"]}
    return rounded(A.spec_aggregate(o, "o_custkey", spec, prefix="ord_"))


ALLCOLS_SQL = """
SELECT p_brand, min(p_size) AS "P_SIZE_MIN", max(p_size) AS "P_SIZE_MAX", round(avg(p_size), 6) AS "P_SIZE_MEAN",
       CAST(sum(p_size) AS BIGINT) AS "P_SIZE_SUM", round(var_samp(p_size), 6) AS "P_SIZE_VAR",
       min(p_retailprice) AS "P_RETAILPRICE_MIN", max(p_retailprice) AS "P_RETAILPRICE_MAX",
       round(avg(p_retailprice), 6) AS "P_RETAILPRICE_MEAN", round(sum(p_retailprice), 6) AS "P_RETAILPRICE_SUM",
       round(var_samp(p_retailprice), 6) AS "P_RETAILPRICE_VAR"
FROM part GROUP BY p_brand
"""


@register("agg_all_columns", "A06", ALLCOLS_SQL)
def q_allcols(spark, sf_dir):
    """The "all numeric columns × five functions" form, per brand."""
    p = table(spark, sf_dir, "part").select("p_brand", "p_size", "p_retailprice")
    return rounded(A.spec_aggregate(p, "p_brand", A.all_columns_spec(p, ["p_brand"])))


SHARES_SQL = """
SELECT o_custkey, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS "o_orderstatus_F_mean",
       round(avg(CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END), 6) AS "o_orderstatus_O_mean",
       round(avg(CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE 0.0 END), 6) AS "o_orderstatus_P_mean",
       round(avg(CASE WHEN o_orderstatus IS NULL THEN 1.0 ELSE 0.0 END), 6) AS "o_orderstatus_nan_mean"
FROM orders GROUP BY o_custkey
"""


@register("agg_category_shares", "A07", SHARES_SQL)
def q_shares(spark, sf_dir):
    """Share of each order status (and missing) per customer, no one-hot table."""
    return rounded(A.category_shares(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus"))


FILTERED_SQL = """
SELECT o_custkey,
       CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0
            THEN round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 6) END AS "CLOSED_O_TOTALPRICE_MEAN",
       CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0
            THEN max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') END AS "CLOSED_O_TOTALPRICE_MAX",
       CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0
            THEN count(*) FILTER (WHERE o_orderstatus = 'F') END AS "CLOSED_O_ORDERKEY_SIZE"
FROM orders GROUP BY o_custkey
"""


@register("agg_filtered", "A08", FILTERED_SQL)
def q_filtered(spark, sf_dir):
    """Spec restricted to closed orders, NULL for customers without any."""
    o = table(spark, sf_dir, "orders")
    spec = {"o_totalprice": ["mean", "max"], "o_orderkey": ["size"]}
    return rounded(A.filtered_aggregate(o, "o_custkey", spec, F.col("o_orderstatus") == "F", "closed_"))


MULTI_SQL = """
SELECT o_custkey, round(avg(o_totalprice), 6) AS "O_TOTALPRICE_MEAN", count(*) AS "O_ORDERKEY_SIZE",
       CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'O') > 0
            THEN round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 6) END AS "ACTIVE_O_TOTALPRICE_MEAN",
       CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'O') > 0
            THEN count(*) FILTER (WHERE o_orderstatus = 'O') END AS "ACTIVE_O_ORDERKEY_SIZE",
       CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0
            THEN round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 6) END AS "CLOSED_O_TOTALPRICE_MEAN",
       CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0
            THEN count(*) FILTER (WHERE o_orderstatus = 'F') END AS "CLOSED_O_ORDERKEY_SIZE"
FROM orders GROUP BY o_custkey
"""


@register("agg_overall_and_status", "J03,A08", MULTI_SQL)
def q_multi(spark, sf_dir):
    """Overall, active and closed sub-aggregates side by side in one aggregate (no join back)."""
    o = table(spark, sf_dir, "orders")
    spec = {"o_totalprice": ["mean"], "o_orderkey": ["size"]}
    return rounded(A.multi_filtered_aggregate(o, "o_custkey", spec, "", {
        "active_": F.col("o_orderstatus") == "O", "closed_": F.col("o_orderstatus") == "F"}))


TWO_LEVEL_SQL = """
WITH j AS (SELECT l.l_orderkey, o.o_custkey, l.l_quantity FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
lv1 AS (SELECT l_orderkey, o_custkey, min(l_quantity) AS qmin, max(l_quantity) AS qmax, count(*) AS sz
        FROM j GROUP BY l_orderkey, o_custkey)
SELECT o_custkey, round(avg(qmin), 6) AS "L_QUANTITY_MIN_MEAN", round(avg(qmax), 6) AS "L_QUANTITY_MAX_MEAN",
       round(avg(sz), 6) AS "L_QUANTITY_SIZE_MEAN"
FROM lv1 GROUP BY o_custkey
"""


@register("agg_two_level", "A09", TWO_LEVEL_SQL)
def q_two_level(spark, sf_dir):
    """Line history → order (min, max, size) → customer (mean of the order-level values)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    hist = li.join(o, "l_orderkey")
    return rounded(A.two_level_aggregate(hist, "l_orderkey", "o_custkey", {"l_quantity": ["min", "max", "size"]}))


DIST_SQL = """
SELECT o_orderpriority, count(*) AS count, round(count(*) / (SELECT count(*) FROM orders), 6) AS share
FROM orders GROUP BY o_orderpriority
"""


@register("agg_value_distribution", "A11", DIST_SQL)
def q_dist(spark, sf_dir):
    """Normalised value counts of the order priority."""
    return rounded(A.value_distribution(table(spark, sf_dir, "orders"), "o_orderpriority"))


DOMINANT_SQL = """
SELECT round(max(n) / sum(n), 6) AS dominant_share FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
"""


@register("agg_dominant_share", "A11", DOMINANT_SQL)
def q_dominant(spark, sf_dir):
    """Share of the most frequent order priority."""
    return rounded(A.dominant_share(table(spark, sf_dir, "orders"), "o_orderpriority"))


TARGET_STATS_SQL = """
SELECT c_mktsegment, round(avg(CASE WHEN c_acctbal < 1000 THEN 1.0 ELSE 0.0 END), 6) AS target_mean,
       round(stddev_samp(CASE WHEN c_acctbal < 1000 THEN 1.0 ELSE 0.0 END), 6) AS target_std, count(*) AS n
FROM customer GROUP BY c_mktsegment
"""


@register("agg_group_target_stats", "A12", TARGET_STATS_SQL)
def q_target_stats(spark, sf_dir):
    """Mean, std and count of a binary target per market segment, sorted by mean."""
    c = table(spark, sf_dir, "customer").withColumn("y", F.when(F.col("c_acctbal") < 1000, 1.0).otherwise(0.0))
    return rounded(A.group_target_stats(c, "c_mktsegment", "y"))


IMPORTANCE_SQL = """
SELECT p_name AS feature, round(avg(p_retailprice / 1000.0), 6) AS importance_mean
FROM part GROUP BY p_name ORDER BY avg(p_retailprice / 1000.0) DESC, p_name LIMIT 40
"""


@register("agg_importance_average", "A16", IMPORTANCE_SQL)
def q_importance(spark, sf_dir):
    """Mean importance per feature over folds, top 40 (parts as folds × features)."""
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("feature"),
                                            (F.col("p_retailprice") / 1000.0).alias("importance"))
    return rounded(A.importance_average(p, "feature", "importance", 40))


# joins ------------------------------------------------------------------------------
INNER3_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name, c_acctbal, c_mktsegment FROM customer
"""


@register("join_inner_three_way", "J02,C21", INNER3_SQL)
def q_inner3(spark, sf_dir):
    """Three sources keyed by differently formatted text keys, normalised, inner-joined."""
    c = table(spark, sf_dir, "customer")
    s1 = c.select(C.normalize_key(F.concat(F.lit("E_"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"))).alias("key"),
                  "c_name")
    s2 = c.select(C.normalize_key(F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("key"), "c_acctbal")
    s3 = c.select(C.normalize_key(F.col("c_custkey").cast("string")).alias("key"), "c_mktsegment")
    return J.inner_join_chain([s1, s2, s3], "key")


SEMI_SQL = """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 100)
"""


@register("join_semi_sample", "J04,S05", SEMI_SQL)
def q_semi(spark, sf_dir):
    """Debug sample: line items of the first 100 order keys (semi join)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return J.semi_join_sample(li, o, "l_orderkey", 100)


RADIUS_SQL = """
WITH p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
SELECT a.vec_id,
       count(*) FILTER (WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.02) AS n_within_0_02,
       count(*) FILTER (WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.05) AS n_within_0_05,
       count(*) FILTER (WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.1) AS n_within_0_1
FROM p a, p b GROUP BY a.vec_id
"""


@register("join_radius_count", "J08", RADIUS_SQL)
def q_radius(spark, sf_dir):
    """Reference points within 0.02 / 0.05 / 0.1 of every point (grid cells, exact)."""
    e = table(spark, sf_dir, "embeddings")
    pts = e.select("vec_id", F.element_at("embedding", 1).cast("double").alias("x"),
                   F.element_at("embedding", 2).cast("double").alias("y"))
    return J.radius_neighbour_counts(pts, pts, [0.02, 0.05, 0.1], id_col="vec_id")


SPHERE_SQL = """
WITH p AS (SELECT vec_id, 48.85 + 0.2 * CAST(embedding[1] AS DOUBLE) AS lat, 2.35 + 0.3 * CAST(embedding[2] AS DOUBLE) AS lon
           FROM embeddings),
d AS (SELECT a.vec_id, 2 * 6371008.8 * asin(sqrt(sin((radians(b.lat) - radians(a.lat)) / 2) ** 2
        + cos(radians(a.lat)) * cos(radians(b.lat)) * sin((radians(b.lon) - radians(a.lon)) / 2) ** 2)) AS m FROM p a, p b)
SELECT vec_id, count(*) FILTER (WHERE m <= 500) AS n_within_500, count(*) FILTER (WHERE m <= 1000) AS n_within_1000,
       count(*) FILTER (WHERE m <= 1500) AS n_within_1500, count(*) FILTER (WHERE m <= 2000) AS n_within_2000
FROM d GROUP BY vec_id
"""


@register("join_radius_metres", "J08", SPHERE_SQL)
def q_sphere(spark, sf_dir):
    """Reference points within 500 / 1000 / 1500 / 2000 metres on the globe (blocks of near points, exact)."""
    e = table(spark, sf_dir, "embeddings")
    pts = e.select("vec_id", (F.lit(48.85) + F.lit(0.2) * F.element_at("embedding", 1).cast("double")).alias("lat"),
                   (F.lit(2.35) + F.lit(0.3) * F.element_at("embedding", 2).cast("double")).alias("lon"))
    return sphere_neighbour_counts(pts, pts, [500, 1000, 1500, 2000], id_col="vec_id")


# ordering and sets --------------------------------------------------------------------
LASTN_SQL = """
SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 50
"""


@register("order_last_n", "W03", LASTN_SQL)
def q_lastn(spark, sf_dir):
    """The 50 newest log rows, newest first."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return A.last_n(e, "ts", 50, tie=["event_id"])


FIRST_SQL = """
SELECT event_type, arg_min(event_id, event_id) AS event_id, arg_min(user_id, event_id) AS user_id,
       arg_min(value, event_id) AS value
FROM events GROUP BY event_type
"""


@register("order_first_per_class", "W04", FIRST_SQL)
def q_first(spark, sf_dir):
    """One sample row per class (smallest id), without a window over the class."""
    e = table(spark, sf_dir, "events").select("event_type", "event_id", "user_id", "value")
    return A.first_per_group(e, "event_type", "event_id")


UNION_SQL = """
SELECT c_custkey, c_acctbal, 'train' AS split FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL
SELECT c_custkey, c_acctbal, 'eval' FROM customer WHERE c_mktsegment = 'BUILDING'
"""


@register("union_train_eval", "W06,M14", UNION_SQL)
def q_union(spark, sf_dir):
    """Train and eval splits unioned by name for the final refit."""
    c = table(spark, sf_dir, "customer")
    tr = c.where(F.col("c_mktsegment") != "BUILDING").select("c_custkey", "c_acctbal", F.lit("train").alias("split"))
    ev = c.where(F.col("c_mktsegment") == "BUILDING").select("c_acctbal", "c_custkey", F.lit("eval").alias("split"))
    return J.union_aligned([tr, ev])
