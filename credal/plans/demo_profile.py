"""Demo queries: column profiling, typing, outliers, correlation (Q01–Q16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from credal.operators import profile as Q
from credal.plans.catalog import register, rounded, table


def line_matrix(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.col("l_discount")).alias("disc"),
        F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.col("l_returnflag")).alias("rf"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))


LINE_SQL = """
lm AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax,
              CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS disc,
              CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS rf,
              CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y
       FROM lineitem)"""

MISSING_SQL = "WITH" + LINE_SQL + """
SELECT * FROM (
  SELECT 'disc' AS "column", count(*) FILTER (WHERE disc IS NULL) AS missing,
         round(count(*) FILTER (WHERE disc IS NULL) * 100.0 / count(*), 6) AS percent, 'double' AS dtype,
         'numerical' AS kind FROM lm
  UNION ALL SELECT 'rf', count(*) FILTER (WHERE rf IS NULL), round(count(*) FILTER (WHERE rf IS NULL) * 100.0 / count(*), 6),
         'string', 'categorical' FROM lm
  UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE l_tax IS NULL),
         round(count(*) FILTER (WHERE l_tax IS NULL) * 100.0 / count(*), 6), 'double', 'numerical' FROM lm)
"""


@register("profile_missing", "Q01", MISSING_SQL)
def q_missing(spark, sf_dir):
    """Missing count, percent, dtype and kind per column."""
    return rounded(Q.missing_summary(line_matrix(spark, sf_dir), ["disc", "rf", "l_tax"]))


TOP_MISSING_SQL = "WITH" + LINE_SQL + """
SELECT * FROM (
  SELECT 'disc' AS "column", count(*) FILTER (WHERE disc IS NULL) AS missing,
         round(count(*) FILTER (WHERE disc IS NULL) * 100.0 / count(*), 6) AS percent, 'double' AS dtype,
         'numerical' AS kind FROM lm
  UNION ALL SELECT 'rf', count(*) FILTER (WHERE rf IS NULL), round(count(*) FILTER (WHERE rf IS NULL) * 100.0 / count(*), 6),
         'string', 'categorical' FROM lm
  UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE l_tax IS NULL),
         round(count(*) FILTER (WHERE l_tax IS NULL) * 100.0 / count(*), 6), 'double', 'numerical' FROM lm)
WHERE percent > 10 ORDER BY percent DESC, "column" LIMIT 10
"""


@register("profile_top_missing", "W02,C26", TOP_MISSING_SQL)
def q_top_missing(spark, sf_dir):
    """Columns above 10 % missing, the first 10 by missing share."""
    return rounded(Q.top_missing(Q.missing_summary(line_matrix(spark, sf_dir), ["disc", "rf", "l_tax"]), 10.0, 10))


CONSTANT_SQL = """
WITH c AS (SELECT c_mktsegment, c_nationkey, c_acctbal, c_acctbal * 0.0 + 7.0 AS seven FROM customer),
cnt AS (
  SELECT 'c_mktsegment' AS col, max(n) AS top FROM (SELECT c_mktsegment, count(*) AS n FROM c GROUP BY 1)
  UNION ALL SELECT 'c_nationkey', max(n) FROM (SELECT c_nationkey, count(*) AS n FROM c GROUP BY 1)
  UNION ALL SELECT 'c_acctbal', max(n) FROM (SELECT c_acctbal, count(*) AS n FROM c GROUP BY 1)
  UNION ALL SELECT 'seven', max(n) FROM (SELECT seven, count(*) AS n FROM c GROUP BY 1)),
s AS (
  SELECT 'c_mktsegment' AS col, count(DISTINCT c_mktsegment) AS d, CAST(NULL AS DOUBLE) AS nv FROM c
  UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey), stddev_samp(c_nationkey) / abs(avg(c_nationkey)) FROM c
  UNION ALL SELECT 'c_acctbal', count(DISTINCT c_acctbal), stddev_samp(c_acctbal) / abs(avg(c_acctbal)) FROM c
  UNION ALL SELECT 'seven', count(DISTINCT seven), stddev_samp(seven) / abs(avg(seven)) FROM c)
SELECT s.col AS "column", d AS distinct_with_null, round(nv, 6) AS normalized_variance,
       round(CAST(top AS DOUBLE) / (SELECT count(*) FROM c), 6) AS dominant_share, d <= 1 AS constant,
       d <= 1 OR CAST(top AS DOUBLE) / (SELECT count(*) FROM c) >= 0.95 OR coalesce(nv < 0.01, false) AS quasi_constant
FROM s JOIN cnt ON s.col = cnt.col
"""


@register("profile_constant", "Q02", CONSTANT_SQL)
def q_constant(spark, sf_dir):
    """Distinct count (with null), σ/|μ|, dominant share, constant flags."""
    c = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey", "c_acctbal",
                                                (F.col("c_acctbal") * 0.0 + 7.0).alias("seven"))
    return rounded(Q.constant_columns(c))


TYPES_SQL = """
WITH c AS (SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS neg_flag,
                  c_custkey AS cust_id FROM customer),
d AS (SELECT 'c_custkey' AS col, 'long' AS dtype, count(DISTINCT c_custkey) AS dc,
             count(*) FILTER (WHERE c_custkey <> floor(c_custkey)) AS frac, false AS idname, true AS num FROM c
      UNION ALL SELECT 'c_nationkey', 'integer', count(DISTINCT c_nationkey),
             count(*) FILTER (WHERE c_nationkey <> floor(c_nationkey)), false, true FROM c
      UNION ALL SELECT 'c_acctbal', 'double', count(DISTINCT c_acctbal),
             count(*) FILTER (WHERE c_acctbal <> floor(c_acctbal)), false, true FROM c
      UNION ALL SELECT 'c_mktsegment', 'string', count(DISTINCT c_mktsegment), 0, false, false FROM c
      UNION ALL SELECT 'neg_flag', 'integer', count(DISTINCT neg_flag), 0, false, true FROM c
      UNION ALL SELECT 'cust_id', 'long', count(DISTINCT cust_id), 0, true, true FROM c),
n AS (SELECT count(*) AS n FROM c)
SELECT col AS "column", dtype, dc AS "distinct", round(dc / n, 6) AS unique_ratio,
       CASE WHEN idname AND dc / n > 0.95 THEN 'identifier'
            WHEN num AND dc = 2 THEN 'binary' WHEN num AND frac = 0 AND dc < 20 THEN 'discrete'
            WHEN num THEN 'continuous' WHEN dc = 2 THEN 'binary' ELSE 'categorical' END AS kind
FROM d, n
"""


@register("profile_column_types", "Q03", TYPES_SQL)
def q_types(spark, sf_dir):
    """Typing: identifier, binary, discrete, continuous, categorical."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("neg_flag"), F.col("c_custkey").alias("cust_id"))
    return rounded(Q.column_types(c))


NUMPROF_SQL = """
WITH x AS (SELECT l_quantity, l_extendedprice, l_discount FROM lineitem),
long AS (SELECT 'l_quantity' AS "column", l_quantity AS v FROM x UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM x
         UNION ALL SELECT 'l_discount', l_discount FROM x),
s AS (SELECT "column", count(v) AS cnt, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS mn,
             quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75, max(v) AS mx,
             skewness(v) AS sk, kurtosis(v) AS ku, count(DISTINCT v) AS d, count(*) AS n
      FROM long GROUP BY 1),
o AS (SELECT l."column", count(*) FILTER (WHERE v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) AS outl
      FROM long l JOIN s USING ("column") GROUP BY 1),
r AS (SELECT s.*, outl * 100.0 / cnt AS opct FROM s JOIN o USING ("column"))
SELECT "column", cnt AS "count", round(mean, 8) AS mean, round(std, 8) AS std, round(mn, 8) AS min, round(q25, 8) AS q25,
       round(q50, 8) AS q50, round(q75, 8) AS q75, round(mx, 8) AS max, n - cnt AS missing, round(mx - mn, 8) AS range,
       round(sk, 8) AS skewness, round(ku, 8) AS kurtosis, round(std / mean, 8) AS cv, d AS "distinct",
       round(opct, 8) AS outlier_pct,
       CASE WHEN sk > 1 AND mn >= 0 THEN 'log' WHEN opct > 5 THEN 'robust' WHEN mx - mn > 1e6 THEN 'extreme_scale'
            ELSE 'standard' END AS recommended
FROM r
"""


@register("profile_numeric", "Q04", NUMPROF_SQL)
def q_numprof(spark, sf_dir):
    """Describe + bias-corrected skewness/kurtosis, CV, outlier share, recommended transform."""
    li = table(spark, sf_dir, "lineitem")
    # 8 decimals: means of 2-decimal prices over 60,000 rows have 7 exact decimals (no rounding ties)
    return rounded(Q.numeric_profile(li, ["l_quantity", "l_extendedprice", "l_discount"]), 8)


DIAG_SQL = """
WITH x AS (SELECT l_quantity, l_extendedprice, l_discount FROM lineitem),
long AS (SELECT 'l_quantity' AS "column", l_quantity AS v FROM x UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM x
         UNION ALL SELECT 'l_discount', l_discount FROM x),
s AS (SELECT "column", count(v) AS cnt, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.75) AS q75,
             skewness(v) AS sk, kurtosis(v) AS ku FROM long GROUP BY 1),
o AS (SELECT l."column", count(*) FILTER (WHERE v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) * 100.0
             / max(cnt) AS opct
      FROM long l JOIN s USING ("column") GROUP BY 1)
SELECT "column",
       CASE WHEN abs(sk) < 0.5 THEN 'symmetric' WHEN sk > 0.5 THEN 'positive_skew' ELSE 'negative_skew' END AS skew_class,
       CASE WHEN ku > 1 THEN 'heavy_tails' WHEN ku < -1 THEN 'flat' ELSE 'normal_tails' END AS tail_class,
       CASE WHEN opct > 5 THEN 'critical' WHEN opct > 0 THEN 'moderate' ELSE 'none' END AS outlier_class,
       CASE WHEN opct > 5 THEN 'log_robust' ELSE 'standardize' END AS action
FROM s JOIN o USING ("column")
"""


@register("profile_distribution", "Q05", DIAG_SQL)
def q_diag(spark, sf_dir):
    """Skew, tail and outlier classes with the suggested action."""
    li = table(spark, sf_dir, "lineitem")
    return Q.distribution_diagnosis(Q.numeric_profile(li, ["l_quantity", "l_extendedprice", "l_discount"]))


OUTLIER_SQL = """
WITH b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round(greatest(q1 - 1.5 * (q3 - q1), least(q3 + 1.5 * (q3 - q1), l_extendedprice)), 6) AS l_extendedprice
FROM lineitem, b
"""


@register("outlier_clip_iqr", "Q06", OUTLIER_SQL)
def q_outlier(spark, sf_dir):
    """IQR (k = 1.5) bounds, values clipped."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    b = Q.outlier_bounds(li, ["l_extendedprice"], "iqr")
    return rounded(Q.treat_outliers(li, b, "clip"))


OUTLIER_REMOVE_SQL = """
WITH b AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, b
WHERE l_extendedprice BETWEEN m - 2 * s AND m + 2 * s
"""


@register("outlier_remove_zscore", "Q06", OUTLIER_REMOVE_SQL)
def q_outlier_remove(spark, sf_dir):
    """z-score (2σ) bounds, rows outside removed."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    b = Q.outlier_bounds(li, ["l_extendedprice"], "zscore", z=2.0)
    return Q.treat_outliers(li, b, "remove")


CARD_SQL = """
WITH d AS (SELECT count(*) AS n, count(DISTINCT p_name) AS a, count(DISTINCT p_brand) AS b, count(DISTINCT p_type) AS c,
                  count(DISTINCT CAST(p_partkey AS VARCHAR)) AS k FROM part)
SELECT col AS "column", dc AS distinct_count, round(dc * 100.0 / n, 6) AS ratio_pct,
       CASE WHEN dc * 100.0 / n > 50 THEN 'drop' WHEN dc <= 10 THEN 'one_hot' WHEN dc <= 18 THEN 'binary'
            ELSE 'target_encoding' END AS action
FROM (SELECT 'p_name' AS col, a AS dc, n FROM d UNION ALL SELECT 'p_brand', b, n FROM d
      UNION ALL SELECT 'p_type', c, n FROM d UNION ALL SELECT 'part_id', k, n FROM d)
"""


@register("cardinality_actions", "Q07", CARD_SQL)
def q_card(spark, sf_dir):
    """Drop identifiers (> 50 % unique), one-hot ≤ 10, binary ≤ 18, else target encoding."""
    p = table(spark, sf_dir, "part").select("p_name", "p_brand", "p_type", F.col("p_partkey").cast("string").alias("part_id"))
    return rounded(Q.cardinality_actions(p, ["p_name", "p_brand", "p_type", "part_id"], binary_max=18))


BINENC_SQL = """
WITH cats AS (SELECT list_sort(list_distinct(list(p_brand))) AS c FROM part),
x AS (SELECT p_partkey, coalesce(list_position(c, p_brand), 0) AS idx, len(c) AS k FROM part, cats)
SELECT p_partkey, CAST((idx >> 4) & 1 AS INTEGER) AS p_brand_0, CAST((idx >> 3) & 1 AS INTEGER) AS p_brand_1,
       CAST((idx >> 2) & 1 AS INTEGER) AS p_brand_2, CAST((idx >> 1) & 1 AS INTEGER) AS p_brand_3,
       CAST(idx & 1 AS INTEGER) AS p_brand_4
FROM x
"""


@register("binary_encoding", "Q08", BINENC_SQL)
def q_binenc(spark, sf_dir):
    """Base-2 encoding of the brand index (25 brands → 5 bit columns)."""
    return Q.binary_encode(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand").drop("p_brand")


INFER_SQL = """
WITH c AS (SELECT c_custkey, c_acctbal, c_mktsegment, c_nationkey, CASE WHEN c_acctbal < 0 THEN 'Y' ELSE 'N' END AS flag,
                  c_name FROM customer),
a AS (SELECT count(*) AS n, count(c_custkey) AS k, count(c_acctbal) AS b, count(c_mktsegment) AS m, count(c_nationkey) AS t,
             count(flag) AS f, count(c_name) AS x, count(DISTINCT c_mktsegment) AS dm, count(DISTINCT c_name) AS dx FROM c),
lists AS (SELECT list_sort(list(DISTINCT c_mktsegment)) AS m, list_sort(list(DISTINCT flag)) AS f, list_sort(list(DISTINCT c_name)) AS x
          FROM c),
maps AS (SELECT '{' || array_to_string(list_transform(m, lambda v: '''' || v || ''': ''' || lower(v) || ''''), ', ') || '}' AS m,
                '{' || array_to_string(list_transform(f, lambda v: '''' || v || ''': ''' || lower(v) || ''''), ', ') || '}' AS f,
                '{' || array_to_string(list_transform(x, lambda v: '''' || v || ''': '''
                       || regexp_replace(lower(v), '[^a-z0-9]+', '_', 'g') || ''''), ', ') || '}' AS x FROM lists),
r AS (
  SELECT 'SK_ID_CURR' AS raw_name, 'identifier' AS type, 'identifier' AS role, 'none' AS encoding, 'none' AS transform,
         NULL AS value_map, (n - k) * 100.0 / n AS null_pct FROM a
  UNION ALL SELECT 'AMT_INCOME_TOTAL', 'numerical', 'feature', 'none', 'log', NULL, (n - b) * 100.0 / n FROM a
  UNION ALL SELECT 'NAME_CONTRACT_TYPE', 'categorical', 'feature',
         CASE WHEN dm <= 15 THEN 'one_hot' WHEN dm < 50 THEN 'ordinal' ELSE 'target' END, 'none',
         CASE WHEN dm <= 15 THEN maps.m END, (n - a.m) * 100.0 / n FROM a, maps
  UNION ALL SELECT 'CNT_SOCIAL_CIRCLE', 'numerical', 'feature', 'none', 'robust', NULL, (n - t) * 100.0 / n FROM a
  UNION ALL SELECT 'FLAG_OWN_CAR', 'binary', 'feature', 'none', 'none', maps.f, (n - a.f) * 100.0 / n FROM a, maps
  UNION ALL SELECT 'C_NAME', 'categorical', 'feature',
         CASE WHEN dx <= 15 THEN 'one_hot' WHEN dx < 50 THEN 'ordinal' ELSE 'target' END, 'none',
         CASE WHEN dx <= 15 THEN maps.x END, (n - a.x) * 100.0 / n FROM a, maps)
SELECT lower(raw_name) AS name, 'application' AS source_table, type, role, encoding, transform, raw_name, value_map, null_pct,
       null_pct >= 30 AS null_alert
FROM r
"""


@register("registry_inference", "Q09,S13", INFER_SQL)
def q_infer(spark, sf_dir):
    """Registry rows inferred from the customer table (type, role, encoding, transform, value map)."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("SK_ID_CURR"), F.col("c_acctbal").alias("AMT_INCOME_TOTAL"),
        F.col("c_mktsegment").alias("NAME_CONTRACT_TYPE"), F.col("c_nationkey").alias("CNT_SOCIAL_CIRCLE"),
        F.when(F.col("c_acctbal") < 0, "Y").otherwise("N").alias("FLAG_OWN_CAR"), F.col("c_name").alias("C_NAME"))
    return Q.infer_registry(c, "application", id_columns=["SK_ID_CURR"])


@register("registry_drift_scan", "Q10,E03")
def q_regdrift(spark, sf_dir):
    """Feature-view columns absent from the registry, with their profile and a suggested spec."""
    from credal.plans.credit_views import credit_registry
    from credal.plans.demo_credit import credit_raw_tables
    from credal.plans.credit_views import build_feature_view
    fv = build_feature_view(credit_raw_tables(spark, sf_dir))
    return rounded(Q.registry_drift_scan(fv, [s.name for s in credit_registry()] + ["split"]))


CORR_SQL = """
SELECT * FROM (
  SELECT 'l_quantity' AS col_a, 'l_extendedprice' AS col_b, round(corr(l_quantity, l_extendedprice), 6) AS rho FROM lineitem
  UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) FROM lineitem
  UNION ALL SELECT 'l_quantity', 'l_tax', round(corr(l_quantity, l_tax), 6) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 6) FROM lineitem
  UNION ALL SELECT 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 6) FROM lineitem)
"""


@register("correlation_pairs", "Q11", CORR_SQL)
def q_corr(spark, sf_dir):
    """Pearson ρ of every pair of numeric line columns (upper triangle)."""
    li = table(spark, sf_dir, "lineitem")
    return rounded(Q.correlation_pairs(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


_REDUNDANT = ["l_quantity", "l_extendedprice", "l_discount", "q2", "p2"]
REDUNDANCY_SQL = """
WITH RECURSIVE x AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_quantity * 2.0 + l_tax AS q2, l_extendedprice / 1000.0 + l_discount AS p2,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
pairs AS (""" + "\n  UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS rho, abs(corr({a}, y)) AS ta, abs(corr({b}, y)) AS tb FROM x"
    for i, a in enumerate(_REDUNDANT) for b in _REDUNDANT[i + 1:]) + """),
p AS (SELECT row_number() OVER (ORDER BY abs(rho) DESC, a, b) AS k, a, b, rho, CASE WHEN ta < tb THEN a ELSE b END AS loser,
             CASE WHEN ta < tb THEN b ELSE a END AS keeper FROM pairs WHERE abs(rho) >= 0.9),
g(k, gone, took) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), false
  UNION ALL
  SELECT p.k, CASE WHEN list_contains(gone, a) OR list_contains(gone, b) THEN gone ELSE list_append(gone, loser) END,
         NOT (list_contains(gone, a) OR list_contains(gone, b))
  FROM g JOIN p ON p.k = g.k + 1)
SELECT loser AS dropped, keeper AS kept, round(rho, 6) AS rho FROM p JOIN g USING (k) WHERE took
"""


@register("redundancy_elimination", "Q12", REDUNDANCY_SQL)
def q_redundancy(spark, sf_dir):
    """Greedy drop of the less target-correlated column of each |ρ| ≥ 0.9 pair."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", (F.col("l_quantity") * 2.0 + F.col("l_tax")).alias("q2"),
        (F.col("l_extendedprice") / 1000.0 + F.col("l_discount")).alias("p2"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))
    cols = ["l_quantity", "l_extendedprice", "l_discount", "q2", "p2"]
    return rounded(Q.redundancy_elimination(Q.correlation_pairs(li, cols), Q.target_correlations(li, cols, "y"), 0.9))


RELEVANT_SQL = """
SELECT * FROM (
  SELECT 'l_quantity' AS "column", round(corr(l_quantity, CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END), 6) AS corr_target FROM lineitem
  UNION ALL SELECT 'l_discount', round(corr(l_discount, CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END), 6) FROM lineitem
  UNION ALL SELECT 'l_tax', round(corr(l_tax, CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END), 6) FROM lineitem)
WHERE abs(corr_target) > 0.05
"""


@register("relevant_features", "Q13", RELEVANT_SQL)
def q_relevant(spark, sf_dir):
    """Features with |corr(feature, target)| > 0.05."""
    li = table(spark, sf_dir, "lineitem").withColumn("y", F.when(F.col("l_discount") >= 0.05, 1).otherwise(0))
    return rounded(Q.relevant_features(li, ["l_quantity", "l_discount", "l_tax"], "y", 0.05))


SCALING_SQL = """
WITH x AS (SELECT l_quantity AS a, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS b, l_tax * 0.0 + 3.0 AS c
           FROM lineitem),
s AS (SELECT 'l_quantity' AS col, avg(a) AS m, stddev_samp(a) AS sd, count(*) FILTER (WHERE a NOT IN (0.0, 1.0)) AS nb FROM x
      UNION ALL SELECT 'r', avg(b), stddev_samp(b), count(*) FILTER (WHERE b NOT IN (0.0, 1.0)) FROM x
      UNION ALL SELECT 'zero', avg(c), stddev_samp(c), count(*) FILTER (WHERE c NOT IN (0.0, 1.0)) FROM x)
SELECT col AS "column",
       CASE WHEN nb = 0 THEN 'binary' WHEN sd IS NULL OR sd = 0 THEN 'zero_variance'
            WHEN abs(m) <= 0.1 AND abs(sd - 1) <= 0.1 THEN 'scaled' ELSE 'to_scale' END AS category
FROM s
UNION ALL SELECT 'l_returnflag', 'categorical'
"""


@register("scaling_check", "Q14", SCALING_SQL)
def q_scaling(spark, sf_dir):
    """To-scale / binary / zero-variance / categorical classes per column."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_quantity", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("r"),
        (F.col("l_tax") * 0.0 + 3.0).alias("zero"), "l_returnflag")
    return Q.scaling_check(li)


@register("derived_column_map", "Q15")
def q_derived(spark, sf_dir):
    """Root columns with a derived twin among the outputs of a transformation."""
    from credal.operators import preprocess as P
    c = table(spark, sf_dir, "customer")
    shifts = P.fit_log_shift(c, ["c_acctbal"])
    out = c.select("*", *P.log_shift_exprs(shifts), *P.winsorize_exprs(P.fit_winsor_bounds(c, ["c_acctbal"]), "_wins"))
    return Q.derived_column_map(spark, out.columns)


STEPS_SQL = "WITH" + LINE_SQL + """,
b AS (SELECT count(*) AS n, count(rf) AS m, count(*) FILTER (WHERE rf IS NOT NULL AND disc IS NULL) AS z FROM lm)
SELECT 1 AS step_no, 'drop_missing_target' AS step, n AS rows_before, 7 AS cols_before, m AS rows_after, 7 AS cols_after,
       'rows without rf' AS detail FROM b
UNION ALL SELECT 2, 'drop_by_pattern', m, 7, m, 6, 'case-insensitive ''tax''' FROM b
UNION ALL SELECT 3, 'drop_missing_share', m, 6, m, CAST(6 - CASE WHEN z * 100.0 / m > 5 THEN 1 ELSE 0 END AS INTEGER),
       '> 5 % missing' FROM b
"""


@register("step_history", "Q16,C25,C26", STEPS_SQL)
def q_steps(spark, sf_dir):
    """Operation records with shapes before and after each cleaning step."""
    h = Q.StepHistory()
    df = line_matrix(spark, sf_dir)
    df = h.record("drop_missing_target", df, df.dropna(subset=["rf"]), "rows without rf")
    df = h.record("drop_by_pattern", df, Q.drop_columns(df, patterns=["TAX"]), "case-insensitive 'tax'")
    h.record("drop_missing_share", df, Q.drop_columns(df, max_missing_pct=5.0), "> 5 % missing")
    return h.to_dataframe(spark)


SPEARMAN_SQL = """
WITH r AS (
  SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS q,
         rank() OVER (ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_discount) - 1) / 2.0 AS d,
         rank() OVER (ORDER BY l_tax) + (count(*) OVER (PARTITION BY l_tax) - 1) / 2.0 AS t
  FROM lineitem)
SELECT * FROM (
  SELECT 'l_quantity' AS col_a, 'l_discount' AS col_b, round(corr(q, d), 6) AS rho FROM r
  UNION ALL SELECT 'l_quantity', 'l_tax', round(corr(q, t), 6) FROM r
  UNION ALL SELECT 'l_discount', 'l_tax', round(corr(d, t), 6) FROM r)
"""


@register("correlation_spearman", "Q11", SPEARMAN_SQL)
def q_spearman(spark, sf_dir):
    """Spearman ρ (Pearson on average ranks, ties shared) of every pair."""
    li = table(spark, sf_dir, "lineitem")
    return rounded(Q.spearman_pairs(li, ["l_quantity", "l_discount", "l_tax"]))


OUTLIER_NULL_SQL = """
WITH b AS (SELECT quantile_cont(o_totalprice, 0.01) AS lo, quantile_cont(o_totalprice, 0.99) AS hi FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice BETWEEN lo AND hi THEN o_totalprice END AS o_totalprice
FROM orders, b
"""


@register("outlier_null_quantile", "Q06", OUTLIER_NULL_SQL)
def q_outlier_null(spark, sf_dir):
    """1 % / 99 % quantile bounds; values outside set to NULL."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return Q.treat_outliers(o, Q.outlier_bounds(o, ["o_totalprice"], "quantile"), "null")
