"""Demo queries: fit / transform preprocessing on the line-item table.

Stand-in matrix (renames and CASE-built missings only):
  q     l_quantity, NULL for open lines with flag N      → standard (+ indicator)
  t     l_tax                                           → standard
  price l_extendedprice − 20000, NULL on line 3          → log (floor at 0)
  disc  l_discount, NULL on line 5                      → robust
  rf    l_returnflag, NULL on line 2                    → one-hot
  ls    l_linestatus                                    → ordinal
  flag  '1' / '0' / 'nan' from the quantity             → binary
  supp  supplier key as text                            → target encoding
  y     l_discount ≥ 0.05                               → target
Fit rows: lines shipped before 1999-01-01; all rows are transformed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from credal.operators import preprocess as P
from credal.plans.catalog import register, rounded, table
from credal.session import written

TRAIN_CUTOFF = "1999-01-01"


def matrix_standin(spark, sf_dir, with_row_id: bool = False):
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    # (order, line) repeats in the driver data; a hash of the whole row identifies a line
    rid = [F.xxhash64(*[F.col(c) for c in li.columns]).alias("row_id")] if with_row_id else []
    return li.select(
        *rid, "l_orderkey", "l_linenumber",
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(None))
         .otherwise(F.col("l_quantity")).alias("q"),
        F.col("l_tax").alias("t"),
        F.when(ln == 3, F.lit(None)).otherwise(F.col("l_extendedprice") - 20000.0).alias("price"),
        F.when(ln == 5, F.lit(None)).otherwise(F.col("l_discount")).alias("disc"),
        F.when(ln == 2, F.lit(None)).otherwise(F.col("l_returnflag")).alias("rf"),
        F.col("l_linestatus").alias("ls"),
        F.when(F.col("l_quantity") > 25, "1").when(F.col("l_quantity") > 10, "0").otherwise("nan").alias("flag"),
        F.col("l_suppkey").cast("string").alias("supp"),
        F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("y"),
        (F.col("l_shipdate") < F.lit(TRAIN_CUTOFF).cast("timestamp_ntz")).alias("is_train"))


SPEC = P.PreprocessSpec(standard=["q", "t"], log=["price"], robust=["disc"], one_hot=["rf"], ordinal=["ls"],
                        binary=["flag"], target_enc=["supp"], target="y", smoothing=1.0)

_MATRIX_SQL = f"""
m AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE l_quantity END AS q,
         l_tax AS t,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice - 20000.0 END AS price,
         CASE WHEN l_linenumber = 5 THEN NULL ELSE l_discount END AS disc,
         CASE WHEN l_linenumber = 2 THEN NULL ELSE l_returnflag END AS rf,
         l_linestatus AS ls,
         CASE WHEN l_quantity > 25 THEN '1' WHEN l_quantity > 10 THEN '0' ELSE 'nan' END AS flag,
         CAST(l_suppkey AS VARCHAR) AS supp,
         CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS y,
         l_shipdate < TIMESTAMP '{TRAIN_CUTOFF}' AS is_train
  FROM lineitem),
tr AS (SELECT * FROM m WHERE is_train)"""

FIT_TRANSFORM_SQL = "WITH" + _MATRIX_SQL + """,
s AS (
  SELECT count(*) AS n,
         quantile_cont(q, 0.5) AS q_med, count(q) AS q_cnt, avg(q) AS q_avg, var_pop(q) AS q_var,
         quantile_cont(t, 0.5) AS t_med, count(t) AS t_cnt, avg(t) AS t_avg, var_pop(t) AS t_var,
         quantile_cont(disc, 0.5) AS d_med,
         avg(ln(1 + greatest(coalesce(price, 0.0), 0.0))) AS p_lavg,
         stddev_pop(ln(1 + greatest(coalesce(price, 0.0), 0.0))) AS p_lstd,
         avg(CAST(y AS DOUBLE)) AS gmean,
         list_sort(list_distinct(list(ls))) AS ls_cats
  FROM tr),
s2 AS (
  SELECT s.*,
    (q_cnt * q_avg + (n - q_cnt) * q_med) / n AS q_mean,
    sqrt((q_var * q_cnt + (q_med - q_avg) * (q_med - q_avg) * q_cnt * (n - q_cnt) / n) / n) AS q_sd0,
    (t_cnt * t_avg + (n - t_cnt) * t_med) / n AS t_mean,
    sqrt((t_var * t_cnt + (t_med - t_avg) * (t_med - t_avg) * t_cnt * (n - t_cnt) / n) / n) AS t_sd0,
    CAST(n - q_cnt AS DOUBLE) / n AS qi_share
  FROM s),
rq AS (
  SELECT quantile_cont(coalesce(disc, (SELECT d_med FROM s)), 0.25) AS q25,
         quantile_cont(coalesce(disc, (SELECT d_med FROM s)), 0.75) AS q75
  FROM tr),
te AS (
  SELECT supp, (count(*) * avg(CAST(y AS DOUBLE)) + 1.0 * (SELECT gmean FROM s)) / (count(*) + 1.0) AS enc
  FROM tr WHERE supp IS NOT NULL GROUP BY 1)
SELECT m.l_orderkey, m.l_linenumber,
  CASE WHEN coalesce(rf, 'unknown') = 'A' THEN 1.0 ELSE 0.0 END AS "ohe__rf_A",
  CASE WHEN coalesce(rf, 'unknown') = 'N' THEN 1.0 ELSE 0.0 END AS "ohe__rf_N",
  CASE WHEN coalesce(rf, 'unknown') = 'R' THEN 1.0 ELSE 0.0 END AS "ohe__rf_R",
  CASE WHEN coalesce(rf, 'unknown') = 'unknown' THEN 1.0 ELSE 0.0 END AS "ohe__rf_unknown",
  CASE WHEN coalesce(list_position(ls_cats, coalesce(ls, 'unknown')), 0) > 0
       THEN CAST(list_position(ls_cats, coalesce(ls, 'unknown')) - 1 AS DOUBLE) ELSE -1.0 END AS "ordinal__ls",
  round((ln(1 + greatest(coalesce(price, 0.0), 0.0)) - p_lavg)
        / (CASE WHEN p_lstd = 0 OR p_lstd IS NULL THEN 1.0 ELSE p_lstd END), 6) AS "log__price",
  round((coalesce(q, q_med) - q_mean) / (CASE WHEN q_sd0 = 0 THEN 1.0 ELSE q_sd0 END), 6) AS "standard__q",
  round((coalesce(t, t_med) - t_mean) / (CASE WHEN t_sd0 = 0 THEN 1.0 ELSE t_sd0 END), 6) AS "standard__t",
  round(((CASE WHEN q IS NULL THEN 1.0 ELSE 0.0 END) - qi_share)
        / (CASE WHEN qi_share * (1 - qi_share) = 0 THEN 1.0 ELSE sqrt(qi_share * (1 - qi_share)) END), 6)
    AS "standard__missingindicator_q",
  round((coalesce(disc, d_med) - d_med) / (CASE WHEN q75 - q25 = 0 THEN 1.0 ELSE q75 - q25 END), 6) AS "robust__disc",
  coalesce(CASE WHEN isnan(TRY_CAST(flag AS DOUBLE)) THEN NULL ELSE TRY_CAST(flag AS DOUBLE) END, 0.0) AS "binary__flag",
  round(coalesce(te.enc, gmean), 6) AS "target_enc__supp"
FROM m CROSS JOIN s2 CROSS JOIN rq LEFT JOIN te ON m.supp = te.supp
"""


@register("fit_transform_matrix", "E01,E02,E04,E05,E06,E07,E09,E10,E12,E14,E15,E16,E19,E20,S14", FIT_TRANSFORM_SQL)
def q_fit_transform(spark, sf_dir):
    """Fit on the training rows, transform every row (one select)."""
    m = matrix_standin(spark, sf_dir)
    params = P.fit(m.where("is_train"), SPEC)
    params = P.Params.from_json(params.to_json())  # S14: the saved parameters drive the transform
    return rounded(P.transform(m, params, keep=["l_orderkey", "l_linenumber"]))


OOF_SQL = """
WITH m AS (
  SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS supp,
         CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS y, l_orderkey % 5 AS fold
  FROM lineitem),
pf AS (SELECT supp, fold, sum(y) AS s, count(*) AS n FROM m GROUP BY supp, fold),
tot AS (SELECT supp, sum(s) AS s, sum(n) AS n FROM pf GROUP BY supp),
g AS (SELECT avg(CAST(y AS DOUBLE)) AS gmean FROM m)
SELECT m.l_orderkey, m.l_linenumber, m.supp, m.y, m.fold,
       round(coalesce(CASE WHEN tot.n - pf.n > 0 THEN CAST(tot.s - pf.s AS DOUBLE) / (tot.n - pf.n) END, g.gmean), 6)
         AS supp_oof
FROM m JOIN pf ON m.supp = pf.supp AND m.fold = pf.fold JOIN tot ON m.supp = tot.supp CROSS JOIN g
"""


@register("target_encoding_oof", "E18,M02", OOF_SQL)
def q_oof(spark, sf_dir):
    """Out-of-fold target encoding of the supplier (5 folds on the order key)."""
    li = table(spark, sf_dir, "lineitem")
    m = li.select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("supp"),
                  F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("y"),
                  (F.col("l_orderkey") % 5).alias("fold"))
    return rounded(P.out_of_fold_target_encoding(m, "supp", "y", "fold", out="supp_oof"))


ADDITIVE_SQL = """
WITH m AS (
  SELECT c_custkey, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS nat,
         CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END AS y, c_mktsegment <> 'BUILDING' AS is_train
  FROM customer),
tr AS (SELECT * FROM m WHERE is_train),
g AS (SELECT avg(CAST(y AS DOUBLE)) AS gmean FROM tr),
enc AS (SELECT nat, (count(*) * avg(CAST(y AS DOUBLE)) + 10.0 * (SELECT gmean FROM g)) / (count(*) + 10.0) AS e
        FROM tr GROUP BY nat)
SELECT m.c_custkey, m.c_mktsegment, m.y, m.is_train, round(coalesce(enc.e, g.gmean), 6) AS "nat_Encoded"
FROM m LEFT JOIN enc ON m.nat = enc.nat CROSS JOIN g
"""


@register("target_encoding_additive", "E17,J06", ADDITIVE_SQL)
def q_additive(spark, sf_dir):
    """Additive smoothed target encoding (s = 10) learned on train, applied to all."""
    c = table(spark, sf_dir, "customer")
    m = c.select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string").alias("nat"),
                 F.when(F.col("c_acctbal") < 1000, 1).otherwise(0).alias("y"),
                 (F.col("c_mktsegment") != "BUILDING").alias("is_train"))
    mapping = P.fit_target_additive(m.where("is_train"), "nat", "y", smoothing=10.0)
    return rounded(P.apply_target_map(m, mapping, "nat"))


LOG_WINSOR_SQL = """
WITH b AS (
  SELECT quantile_cont(c_acctbal, 0.01) AS lo, quantile_cont(c_acctbal, 0.99) AS hi, min(c_acctbal) AS mn
  FROM customer)
SELECT c_custkey,
       round(greatest(lo, least(hi, c_acctbal)), 6) AS c_acctbal_wins,
       round(ln(1 + c_acctbal + CASE WHEN mn < 0 THEN abs(mn) + 1 ELSE 0 END), 6) AS c_acctbal_log
FROM customer CROSS JOIN b
"""


@register("log_shift_winsorize", "E08,E11", LOG_WINSOR_SQL)
def q_log_winsor(spark, sf_dir):
    """Learned log shift (|min|+1) and 1 %/99 % winsorising of the balance."""
    c = table(spark, sf_dir, "customer")
    shifts = P.fit_log_shift(c, ["c_acctbal"])
    bounds = P.fit_winsor_bounds(c, ["c_acctbal"])
    return rounded(c.select("c_custkey", *P.winsorize_exprs(bounds, suffix="_wins"),
                            *P.log_shift_exprs(shifts, suffix="_log")))


DROP_FIRST_SQL = """
SELECT c_custkey,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS "c_mktsegment_BUILDING",
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS "c_mktsegment_FURNITURE",
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS "c_mktsegment_HOUSEHOLD",
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS "c_mktsegment_MACHINERY"
FROM customer
"""


@register("one_hot_drop_first", "E13,A11", DROP_FIRST_SQL)
def q_drop_first(spark, sf_dir):
    """Dummies of the market segment without the first sorted category."""
    from credal.operators.aggregate import distinct_values
    c = table(spark, sf_dir, "customer")
    cats = {"c_mktsegment": distinct_values(c, "c_mktsegment")}
    return c.select("c_custkey", *P.one_hot_drop_first_exprs(cats))


QUALITY_SQL = """
WITH m AS (
  SELECT l_quantity, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS disc,
         CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS r, l_tax * 0.0 AS zero,
         CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS y
  FROM lineitem),
a AS (
  SELECT count(*) FILTER (WHERE l_quantity IS NULL OR isnan(l_quantity)) AS qn, 0 AS qi, min(l_quantity) = max(l_quantity) AS qc,
         count(*) FILTER (WHERE disc IS NULL OR isnan(disc)) AS dn, 0 AS di, min(disc) = max(disc) AS dc,
         count(*) FILTER (WHERE r IS NULL OR isnan(r)) AS rn, 0 AS ri, min(r) = max(r) AS rc,
         count(*) FILTER (WHERE zero IS NULL OR isnan(zero)) AS zn, 0 AS zi, min(zero) = max(zero) AS zc,
         avg(CAST(y AS DOUBLE)) AS class_rate
  FROM m)
SELECT 'l_quantity' AS "column", qn AS nulls, CAST(qi AS BIGINT) AS infinite, qc AS constant, round(class_rate, 6) AS class_rate,
       class_rate < 0.05 AS imbalanced FROM a
UNION ALL SELECT 'disc', dn, CAST(di AS BIGINT), dc, round(class_rate, 6), class_rate < 0.05 FROM a
UNION ALL SELECT 'r', rn, CAST(ri AS BIGINT), rc, round(class_rate, 6), class_rate < 0.05 FROM a
UNION ALL SELECT 'zero', zn, CAST(zi AS BIGINT), zc, round(class_rate, 6), class_rate < 0.05 FROM a
"""


@register("matrix_quality", "E21,C27", QUALITY_SQL)
def q_quality(spark, sf_dir):
    """Quality control of a matrix: nulls, infinities, constant columns, class rate."""
    li = table(spark, sf_dir, "lineitem")
    m = li.select("l_quantity", F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.col("l_discount")).alias("disc"),
                  F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("r"),
                  (F.col("l_tax") * 0.0).alias("zero"),
                  F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("y"))
    return rounded(P.matrix_quality(m, ["l_quantity", "disc", "r", "zero"], target="y"))


def matrix_sql(extra: str = "") -> str:
    """The fitted matrix before rounding, with further columns of ``m``."""
    exact = FIT_TRANSFORM_SQL.replace(", 6)", ", 15)")
    return exact.replace("SELECT m.l_orderkey, m.l_linenumber,", f"SELECT m.l_orderkey, m.l_linenumber, {extra}", 1)


AUDIT_SQL = "WITH x AS (" + matrix_sql("m.is_train,") + """),
per AS (
  SELECT name, avg(v) AS mean, stddev_pop(v) AS std FROM
    (UNPIVOT (SELECT * EXCLUDE (l_orderkey, l_linenumber, is_train) FROM x WHERE is_train) ON COLUMNS(*) INTO NAME name VALUE v)
  GROUP BY name),
gaps AS (
  SELECT count(*) * (SELECT count(*) FROM per) AS cells,
         (SELECT count(*) FROM (UNPIVOT (SELECT * EXCLUDE (l_orderkey, l_linenumber, is_train) FROM x WHERE is_train)
                                ON COLUMNS(*) INTO NAME name VALUE v)) AS filled
  FROM x WHERE is_train)
SELECT true AS same_columns, (SELECT cells = filled FROM gaps) AS no_nulls,
       round(avg(CASE WHEN abs(mean) <= 0.1 AND abs(std - 1) <= 0.1 THEN 1.0 ELSE 0.0 END), 6) AS scaled_share,
       count(*) AS n_columns
FROM per
"""


@register("final_audit", "E22,W07", AUDIT_SQL)
def q_final_audit(spark, sf_dir):
    """Final audit of a fitted matrix: column alignment, no nulls, scaled share."""
    m = matrix_standin(spark, sf_dir)
    params = P.fit(m.where("is_train"), SPEC)
    tr = P.transform(m.where("is_train"), params)
    te = P.transform(m.where(~F.col("is_train")), params)
    return rounded(P.final_audit(tr, te, params.feature_names))


IMPUTE_SQL = """
WITH m AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS disc,
         CASE WHEN l_linenumber = 2 THEN NULL ELSE l_returnflag END AS rf,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE l_shipdate END AS ship,
         CASE WHEN l_linenumber = 5 THEN NULL ELSE l_tax END AS tax
  FROM lineitem),
md AS (SELECT quantile_cont(disc, 0.5) AS med FROM m),
mo AS (SELECT rf AS mode FROM m WHERE rf IS NOT NULL GROUP BY rf ORDER BY count(*) DESC, rf LIMIT 1)
SELECT l_orderkey, l_linenumber, round(coalesce(disc, (SELECT med FROM md)), 6) AS disc,
       coalesce(rf, (SELECT mode FROM mo)) AS rf, round(coalesce(tax, 0.0), 6) AS tax, ship
FROM m
"""


@register("impute_median_mode", "E04,E05", IMPUTE_SQL)
def q_impute(spark, sf_dir):
    """Median (numeric), most frequent value (categorical, smallest on ties) and a
    constant override (0) learned once and applied by coalesce."""
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    m = li.select("l_orderkey", "l_linenumber",
                  F.when(ln == 3, F.lit(None)).otherwise(F.col("l_discount")).alias("disc"),
                  F.when(ln == 2, F.lit(None)).otherwise(F.col("l_returnflag")).alias("rf"),
                  F.when(ln == 4, F.lit(None)).otherwise(F.col("l_shipdate")).alias("ship"),
                  F.when(ln == 5, F.lit(None)).otherwise(F.col("l_tax")).alias("tax"))
    values = P.fit_imputation(m, numeric=["disc"], categorical=["rf"], overrides={"tax": 0.0})
    return rounded(m.select(*P.impute_exprs(m, values)))


MODES_SQL = """
WITH long AS (SELECT 'c_mktsegment' AS "column", c_mktsegment AS v FROM customer
              UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer),
c AS (SELECT "column", v, count(*) AS n FROM long WHERE v IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) AS rk FROM c)
SELECT "column", v AS mode, n AS count FROM r WHERE rk = 1
"""


@register("column_modes", "E04,A11", MODES_SQL)
def q_modes(spark, sf_dir):
    """Most frequent value per column (smallest on ties) without per-column value maps."""
    from credal.operators.aggregate import column_modes
    return column_modes(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"])


TOOLKIT_SQL = """
WITH m AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_tax,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS disc,
         CASE WHEN l_linenumber <= 2 THEN NULL ELSE l_extendedprice END AS price,
         l_linestatus
  FROM lineitem),
s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_tax) AS mt, stddev_samp(l_tax) AS st FROM m)
SELECT l_orderkey, l_linenumber,
       round((l_quantity - mq) / sq, 6) AS l_quantity_scaled, round((l_tax - mt) / st, 6) AS l_tax_scaled,
       CAST(price IS NULL AS INTEGER) AS "price_Manquant",
       CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS l_linestatus
FROM m, s
"""


@register("toolkit_scale_indicators_factorize", "E06,E09,C23", TOOLKIT_SQL)
def q_toolkit(spark, sf_dir):
    """Toolkit variants: sample-σ standardisation, _Manquant indicators above 20 %
    missing, factorized two-value status."""
    li = table(spark, sf_dir, "lineitem")
    m = li.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax",
                  F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.col("l_discount")).alias("disc"),
                  F.when(F.col("l_linenumber") <= 2, F.lit(None)).otherwise(F.col("l_extendedprice")).alias("price"),
                  "l_linestatus")
    std = P.fit_standard(m, ["l_quantity", "l_tax"], ddof=1)
    ind = P.missing_indicator_exprs(m, 0.2, ["disc", "price"])
    out = m.select("l_orderkey", "l_linenumber", *P.standardize_exprs(std, "_scaled"), *ind, "l_linestatus")
    return rounded(P.factorize(out, ["l_linestatus"]))


def wide_matrix(spark, sf_dir):
    """A wide stand-in (≈ 130 fitted output columns): line items with their
    order, customer, part and supplier attributes, a few CASE-built missings."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment",
                                                F.col("c_nationkey").cast("string").alias("c_nation"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", F.col("s_nationkey").cast("string").alias("s_nation"))
    # customers go to the orders first: the line items, the largest side, move once for both
    oc = o.join(c, F.col("o_custkey") == c.c_custkey)
    j = (li.join(s, li.l_suppkey == s.s_suppkey).join(p, li.l_partkey == p.p_partkey)
         .join(oc, li.l_orderkey == F.col("o_orderkey")))
    ln = F.col("l_linenumber")
    return j.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "o_totalprice", "p_size",
        "p_retailprice", "l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority", "c_mktsegment",
        "p_brand", "p_type", "c_nation", "s_nation",
        F.when(ln == 3, F.lit(None)).otherwise(F.col("l_discount")).alias("disc"),
        F.when(ln == 4, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(ln == 5, F.lit(None)).otherwise(F.col("s_acctbal")).alias("s_acctbal"),
        F.datediff("l_shipdate", "o_orderdate").cast("double").alias("ship_days"),
        F.col("l_suppkey").cast("string").alias("supp"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        (F.col("l_shipdate") < F.lit(TRAIN_CUTOFF).cast("timestamp_ntz")).alias("is_train"))


WIDE_SPEC = P.PreprocessSpec(
    standard=["l_quantity", "l_tax", "p_size", "disc", "c_acctbal", "s_acctbal", "ship_days"],
    log=["l_extendedprice", "o_totalprice", "p_retailprice"],
    one_hot=["l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority", "c_mktsegment", "p_brand",
             "p_type", "c_nation", "s_nation"],
    target_enc=["supp"], target="y")


@register("fit_transform_wide", "E12,E16,E20,J01")
def q_wide(spark, sf_dir):
    """Wide matrix: fit on the early rows, transform all rows (~130 columns)."""
    # each fit job reads its columns of the joined rows, which are written once
    m = written(wide_matrix(spark, sf_dir), "wide")
    params = P.fit(m.where("is_train"), WIDE_SPEC)
    return P.transform(m, params, keep=["l_orderkey", "l_linenumber", "y"])
