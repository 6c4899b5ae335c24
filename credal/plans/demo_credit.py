"""Demo: the credit feature-view stack on stand-ins built from the driver tables.

The stand-ins only rename and derive columns into the raw credit schema
(no aggregation, no filtering); all the work — registry select, recoding,
sentinel, five aggregates, master join, fe1–fe10 — runs in
``credal.plans.credit_views``.

  application  ← customer (test split: market segment BUILDING)
  bureau, previous_application ← orders
  bureau_balance ← lineitem (credit key = order key)
  pos_cash, credit_card ← events (user_id as client key)
  installments ← lineitem ⋈ orders (client key of the order)
"""

from __future__ import annotations

from pyspark.sql import functions as F

from credal.plans.catalog import register, rounded, table
from credal.plans.credit_views import build_feature_view

EPOCH = "2002-01-01"


def _days(c):
    return F.datediff(F.col(c), F.lit(EPOCH)).cast("double")


def application_raw(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    seg, nat, bal = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")
    return c.select(
        F.col("c_custkey").alias("sk_id_curr"),
        F.when(bal < 0, "1").otherwise("0").alias("target"),
        F.when(nat < 12, "F").when(nat < 24, "M").otherwise("XNA").alias("code_gender"),
        seg.alias("name_contract_type"),
        bal.alias("amt_income_total"),
        ((nat + 1) * 1000.0).alias("amt_credit"),
        ((nat + 1) * 45.5).alias("amt_annuity"),
        (-(bal + 10000.0)).alias("days_birth"),
        F.when(seg == "MACHINERY", F.lit(365243.0)).otherwise(bal - 5000.0).alias("days_employed"),
        (nat - 3.0).alias("cnt_fam_members"),
        F.when(seg == "AUTOMOBILE", F.lit(None)).otherwise((bal + 1000.0) / 11000.0).alias("ext_source_1"),
        F.when(nat > 20, F.lit(None)).otherwise(nat / 25.0).alias("ext_source_2"),
        F.when(seg == "HOUSEHOLD", F.lit(None)).otherwise(1.0 - (bal + 1000.0) / 11000.0).alias("ext_source_3"),
        (seg == "BUILDING").alias("_is_test"))


def bureau_raw(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    st, pr, tp = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    return o.select(
        F.col("o_custkey").alias("sk_id_curr"), F.col("o_orderkey").alias("sk_id_bureau"),
        F.when(st == "O", "Active").when(st == "F", "Closed").otherwise(" sold ").alias("credit_active"),
        _days("o_orderdate").alias("days_credit"),
        F.when(pr == "1-URGENT", 30.0).when(pr == "2-HIGH", 5.0).otherwise(0.0).alias("credit_day_overdue"),
        tp.alias("amt_credit_sum"),
        (tp - 150000.0).alias("amt_credit_sum_debt"),
        F.when(st == "P", F.lit(None)).otherwise(tp / 10.0).alias("amt_credit_sum_limit"),
        F.when(pr == "5-LOW", 1.0).otherwise(0.0).alias("cnt_credit_prolong"))


def bureau_balance_raw(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rf = F.col("l_returnflag")
    return li.select(F.col("l_orderkey").alias("sk_id_bureau"), (-F.col("l_linenumber")).cast("double").alias("months_balance"),
                     F.when(rf == "R", "1").when(rf == "A", "C").otherwise("X").alias("status"))


def previous_raw(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    pr, tp = F.col("o_orderpriority"), F.col("o_totalprice")
    return o.select(
        F.col("o_custkey").alias("sk_id_curr"), F.col("o_orderkey").alias("sk_id_prev"),
        F.when(pr == "1-URGENT", "Refused").when(pr == "2-HIGH", "Canceled")
         .when(pr == "3-MEDIUM", "Unused offer").otherwise("Approved").alias("name_contract_status"),
        tp.alias("amt_credit"), (tp / 7.0).alias("amt_annuity"),
        _days("o_orderdate").alias("days_decision"),
        F.when(F.col("o_orderstatus") == "F", F.lit(0.1)).alias("rate_down_payment"),
        F.lit(12.0).alias("cnt_payment"))


def pos_cash_raw(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    et, v = F.col("event_type"), F.col("value")
    return e.select(
        F.col("user_id").alias("sk_id_curr"), F.col("event_id").alias("sk_id_prev"),
        (-F.dayofmonth("ts")).cast("double").alias("months_balance"),
        F.when(et == "error", v).otherwise(0.0).alias("sk_dpd"),
        F.when((et == "error") & (v > 100), v).otherwise(0.0).alias("sk_dpd_def"),
        F.get_json_object("props", "$.k").cast("double").alias("cnt_instalment"),
        (v / 10.0).alias("cnt_instalment_future"))


def credit_card_raw(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    et, v = F.col("event_type"), F.col("value")
    return e.select(
        F.col("user_id").alias("sk_id_curr"), F.col("event_id").alias("sk_id_prev"),
        (v * 100.0).alias("amt_balance"), F.lit(10000.0).alias("amt_credit_limit_actual"),
        F.when(et == "purchase", v).otherwise(0.0).alias("amt_drawings_current"),
        F.when(et == "signup", F.lit(None)).otherwise(v).alias("amt_payment_total_current"),
        F.when(et == "error", 1.0).otherwise(0.0).alias("sk_dpd"),
        F.when(et == "purchase", 1.0).otherwise(0.0).alias("cnt_drawings_current"))


def installments_raw(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("sk_id_curr"), F.col("l_orderkey").alias("sk_id_prev"),
        (_days("o_orderdate") + 30.0).alias("days_instalment"),
        _days("l_shipdate").alias("days_entry_payment"),
        F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_extendedprice")).alias("amt_instalment"),
        (F.col("l_extendedprice") * (1.0 - F.col("l_discount"))).alias("amt_payment"))


def credit_raw_tables(spark, sf_dir) -> dict:
    app = application_raw(spark, sf_dir)
    return {
        "application_train": app.where(~F.col("_is_test")).drop("_is_test"),
        "application_test": app.where(F.col("_is_test")).drop("_is_test"),
        "bureau": bureau_raw(spark, sf_dir),
        "bureau_balance": bureau_balance_raw(spark, sf_dir),
        "previous_application": previous_raw(spark, sf_dir),
        "pos_cash": pos_cash_raw(spark, sf_dir),
        "credit_card": credit_card_raw(spark, sf_dir),
        "installments": installments_raw(spark, sf_dir),
    }


_STANDINS_SQL = f"""
app_raw AS (
  SELECT c_custkey AS sk_id_curr, CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS target,
         CASE WHEN c_nationkey < 12 THEN 'F' WHEN c_nationkey < 24 THEN 'M' ELSE 'XNA' END AS code_gender,
         c_mktsegment AS name_contract_type, c_acctbal AS amt_income_total,
         (c_nationkey + 1) * 1000.0 AS amt_credit, (c_nationkey + 1) * 45.5 AS amt_annuity,
         -(c_acctbal + 10000.0) AS days_birth,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 365243.0 ELSE c_acctbal - 5000.0 END AS days_employed,
         c_nationkey - 3.0 AS cnt_fam_members,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE (c_acctbal + 1000.0) / 11000.0 END AS ext_source_1,
         CASE WHEN c_nationkey > 20 THEN NULL ELSE c_nationkey / 25.0 END AS ext_source_2,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE 1.0 - (c_acctbal + 1000.0) / 11000.0 END AS ext_source_3,
         c_mktsegment = 'BUILDING' AS is_test
  FROM customer),
app AS (
  SELECT sk_id_curr, CASE WHEN is_test THEN NULL ELSE CAST(target AS INTEGER) END AS target,
         coalesce(CASE upper(trim(code_gender)) WHEN 'F' THEN 'f' WHEN 'M' THEN 'm' WHEN 'XNA' THEN 'xna' END,
                  'unknown') AS code_gender,
         lower(trim(name_contract_type)) AS name_contract_type,
         amt_income_total, amt_credit, amt_annuity, days_birth,
         CASE WHEN days_employed = 365243 THEN NULL ELSE days_employed END AS days_employed,
         cnt_fam_members, ext_source_1, ext_source_2, ext_source_3,
         CASE WHEN is_test THEN 'test' ELSE 'train' END AS split
  FROM app_raw),
bureau AS (
  SELECT o_custkey AS sk_id_curr, o_orderkey AS sk_id_bureau,
         CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'closed' ELSE 'sold' END AS credit_active,
         CAST(date_diff('day', DATE '{EPOCH}', CAST(o_orderdate AS DATE)) AS DOUBLE) AS days_credit,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 30.0 WHEN o_orderpriority = '2-HIGH' THEN 5.0 ELSE 0.0 END
           AS credit_day_overdue,
         o_totalprice AS amt_credit_sum, o_totalprice - 150000.0 AS amt_credit_sum_debt,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 10.0 END AS amt_credit_sum_limit,
         CASE WHEN o_orderpriority = '5-LOW' THEN 1.0 ELSE 0.0 END AS cnt_credit_prolong
  FROM orders),
bb AS (
  SELECT l_orderkey AS sk_id_bureau, CAST(-l_linenumber AS DOUBLE) AS months_balance,
         CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN 'C' ELSE 'X' END AS status
  FROM lineitem),
prev AS (
  SELECT o_custkey AS sk_id_curr,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'refused' WHEN '2-HIGH' THEN 'canceled'
              WHEN '3-MEDIUM' THEN 'unused_offer' ELSE 'approved' END AS name_contract_status,
         o_totalprice AS amt_credit, o_totalprice / 7.0 AS amt_annuity,
         CAST(date_diff('day', DATE '{EPOCH}', CAST(o_orderdate AS DATE)) AS DOUBLE) AS days_decision,
         CASE WHEN o_orderstatus = 'F' THEN 0.1 END AS rate_down_payment, 12.0 AS cnt_payment
  FROM orders),
pos AS (
  SELECT user_id AS sk_id_curr, CAST(-day(ts) AS DOUBLE) AS months_balance,
         CASE WHEN event_type = 'error' THEN value ELSE 0.0 END AS sk_dpd,
         CASE WHEN event_type = 'error' AND value > 100 THEN value ELSE 0.0 END AS sk_dpd_def,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS cnt_instalment,
         value / 10.0 AS cnt_instalment_future
  FROM events),
cc AS (
  SELECT user_id AS sk_id_curr, value * 100.0 AS amt_balance, 10000.0 AS amt_credit_limit_actual,
         CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS amt_drawings_current,
         CASE WHEN event_type = 'signup' THEN NULL ELSE value END AS amt_payment_total_current,
         CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END AS sk_dpd,
         CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS cnt_drawings_current
  FROM events),
ins AS (
  SELECT o.o_custkey AS sk_id_curr,
         CAST(date_diff('day', DATE '{EPOCH}', CAST(o.o_orderdate AS DATE)) AS DOUBLE) + 30.0 AS days_instalment,
         CAST(date_diff('day', DATE '{EPOCH}', CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS days_entry_payment,
         CASE WHEN l.l_returnflag = 'R' THEN 0.0 ELSE l.l_extendedprice END AS amt_instalment,
         l.l_extendedprice * (1.0 - l.l_discount) AS amt_payment
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
ins_clean AS (
  SELECT *, days_entry_payment - days_instalment AS payment_delay_days,
         CASE WHEN amt_instalment > 0 THEN amt_payment / amt_instalment END AS payment_ratio
  FROM ins)"""

_AGGS_SQL = """
agg_bureau AS (
  SELECT sk_id_curr, count(*) AS bureau_credit_count, avg(amt_credit_sum) AS bureau_amt_credit_sum_mean,
         sum(amt_credit_sum) AS bureau_amt_credit_sum_total, max(days_credit) AS bureau_days_credit_max,
         min(days_credit) AS bureau_days_credit_min, avg(amt_credit_sum_debt) AS bureau_amt_credit_sum_debt_mean,
         sum(amt_credit_sum_debt) AS bureau_amt_credit_sum_debt_total,
         count(*) FILTER (WHERE credit_active = 'active') AS bureau_active_credit_count,
         count(*) FILTER (WHERE credit_active = 'closed') AS bureau_closed_credit_count,
         count(*) FILTER (WHERE credit_day_overdue > 0) AS bureau_overdue_count,
         avg(credit_day_overdue) AS bureau_credit_day_overdue_mean, avg(cnt_credit_prolong) AS bureau_cnt_prolong_mean,
         avg(amt_credit_sum_limit) AS bureau_credit_limit_mean
  FROM bureau GROUP BY sk_id_curr),
bb_credit AS (
  SELECT sk_id_bureau, min(months_balance) AS months_min, max(months_balance) AS months_max, count(*) AS records,
         avg(CASE WHEN status IN ('1', '2', '3', '4', '5') THEN 1.0 ELSE 0.0 END) AS late_share
  FROM bb GROUP BY sk_id_bureau),
agg_bb AS (
  SELECT b.sk_id_curr, count(*) AS bb_credit_count, avg(months_min) AS bb_months_min_mean,
         avg(months_max) AS bb_months_max_mean, avg(records) AS bb_records_mean, avg(late_share) AS bb_late_share_mean
  FROM bb_credit c JOIN bureau b ON c.sk_id_bureau = b.sk_id_bureau GROUP BY b.sk_id_curr),
agg_prev AS (
  SELECT sk_id_curr, count(*) AS prev_app_count,
         count(*) FILTER (WHERE name_contract_status = 'approved') AS prev_approved_count,
         count(*) FILTER (WHERE name_contract_status = 'refused') AS prev_refused_count,
         count(*) FILTER (WHERE name_contract_status = 'canceled') AS prev_canceled_count,
         avg(amt_credit) AS prev_amt_credit_mean, max(amt_credit) AS prev_amt_credit_max,
         avg(amt_annuity) AS prev_amt_annuity_mean, max(days_decision) AS prev_days_decision_max,
         avg(rate_down_payment) AS prev_rate_down_mean, avg(cnt_payment) AS prev_cnt_payment_mean,
         avg(CASE WHEN name_contract_status = 'refused' THEN 1.0 ELSE 0.0 END) AS prev_refusal_rate
  FROM prev GROUP BY sk_id_curr),
agg_pos AS (
  SELECT sk_id_curr, count(*) AS pos_records_count, avg(months_balance) AS pos_months_balance_mean,
         max(sk_dpd) AS pos_sk_dpd_max, avg(sk_dpd) AS pos_sk_dpd_mean, max(sk_dpd_def) AS pos_sk_dpd_def_max,
         avg(cnt_instalment) AS pos_cnt_instalment_mean, avg(cnt_instalment_future) AS pos_cnt_instalment_future_mean,
         count(*) FILTER (WHERE sk_dpd > 0) AS pos_dpd_count
  FROM pos GROUP BY sk_id_curr),
agg_cc AS (
  SELECT sk_id_curr, count(*) AS cc_records_count, avg(amt_balance) AS cc_amt_balance_mean,
         max(amt_balance) AS cc_amt_balance_max, avg(amt_credit_limit_actual) AS cc_credit_limit_mean,
         sum(amt_drawings_current) AS cc_amt_drawings_current_sum, avg(amt_drawings_current) AS cc_amt_drawings_current_mean,
         avg(amt_payment_total_current) AS cc_payment_total_mean, max(sk_dpd) AS cc_sk_dpd_max,
         avg(sk_dpd) AS cc_sk_dpd_mean, avg(cnt_drawings_current) AS cc_cnt_drawings_mean,
         count(*) FILTER (WHERE sk_dpd > 0) AS cc_dpd_count
  FROM cc GROUP BY sk_id_curr),
agg_ins AS (
  SELECT sk_id_curr, count(*) AS install_records_count, avg(payment_delay_days) AS install_payment_delay_mean,
         max(payment_delay_days) AS install_dpd_max,
         count(*) FILTER (WHERE payment_delay_days > 0) AS install_late_count,
         avg(payment_ratio) AS install_payment_ratio_mean, min(payment_ratio) AS install_payment_ratio_min,
         avg(amt_payment) AS install_amt_payment_mean, avg(amt_instalment) AS install_amt_instalment_mean,
         avg(CASE WHEN payment_delay_days > 0 THEN 1.0 ELSE 0.0 END) AS install_late_rate
  FROM ins_clean GROUP BY sk_id_curr),
master AS (
  SELECT app.*, b.* EXCLUDE (sk_id_curr), bbx.* EXCLUDE (sk_id_curr), p.* EXCLUDE (sk_id_curr),
         po.* EXCLUDE (sk_id_curr), c.* EXCLUDE (sk_id_curr), i.* EXCLUDE (sk_id_curr)
  FROM app
  LEFT JOIN agg_bureau b ON app.sk_id_curr = b.sk_id_curr
  LEFT JOIN agg_bb bbx ON app.sk_id_curr = bbx.sk_id_curr
  LEFT JOIN agg_prev p ON app.sk_id_curr = p.sk_id_curr
  LEFT JOIN agg_pos po ON app.sk_id_curr = po.sk_id_curr
  LEFT JOIN agg_cc c ON app.sk_id_curr = c.sk_id_curr
  LEFT JOIN agg_ins i ON app.sk_id_curr = i.sk_id_curr),
fe AS (
  SELECT m.*,
    CASE WHEN amt_income_total > 0 THEN amt_credit / amt_income_total END AS fe1_credit_income_ratio,
    CASE WHEN amt_income_total > 0 THEN (amt_annuity * 12) / amt_income_total END AS fe2_annuity_income_ratio,
    CASE WHEN amt_credit > 0 THEN amt_annuity / amt_credit END AS fe3_payment_rate,
    CASE WHEN days_birth <> 0 AND days_employed < 0 THEN days_employed / days_birth END AS fe4_days_employed_ratio,
    abs(days_birth) / 365.25 AS fe5_age_years,
    CASE WHEN cnt_fam_members > 0 THEN amt_income_total / cnt_fam_members END AS fe6_income_per_person,
    (coalesce(ext_source_1, 0) + coalesce(ext_source_2, 0) + coalesce(ext_source_3, 0))
      / nullif((CASE WHEN ext_source_1 IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN ext_source_2 IS NOT NULL THEN 1 ELSE 0 END
                + CASE WHEN ext_source_3 IS NOT NULL THEN 1 ELSE 0 END), 0) AS fe7_ext_sources_mean,
    least(ext_source_1, ext_source_2, ext_source_3) AS fe8_ext_sources_min,
    CASE WHEN coalesce(bureau_credit_count, 0) > 0
         THEN CAST(coalesce(bureau_overdue_count, 0) AS DOUBLE) / bureau_credit_count ELSE 0.0 END
      AS fe9_bureau_overdue_rate,
    (coalesce(1.0 - ext_source_2, 0.5) + coalesce(1.0 - ext_source_3, 0.5)
     + coalesce(CAST(coalesce(bureau_overdue_count, 0) AS DOUBLE) / nullif(bureau_credit_count, 0), 0.0)) / 3.0
      AS fe10_composite_risk_score
  FROM master m)"""

CREDIT_FEATURE_VIEW_SQL = "WITH " + _STANDINS_SQL + "," + _AGGS_SQL + """
SELECT * REPLACE (
  round(amt_income_total, 6) AS amt_income_total, round(amt_credit, 6) AS amt_credit,
  round(amt_annuity, 6) AS amt_annuity, round(days_birth, 6) AS days_birth, round(days_employed, 6) AS days_employed,
  round(cnt_fam_members, 6) AS cnt_fam_members, round(ext_source_1, 6) AS ext_source_1,
  round(ext_source_2, 6) AS ext_source_2, round(ext_source_3, 6) AS ext_source_3,
  round(bureau_amt_credit_sum_mean, 6) AS bureau_amt_credit_sum_mean,
  round(bureau_amt_credit_sum_total, 6) AS bureau_amt_credit_sum_total,
  round(bureau_days_credit_max, 6) AS bureau_days_credit_max, round(bureau_days_credit_min, 6) AS bureau_days_credit_min,
  round(bureau_amt_credit_sum_debt_mean, 6) AS bureau_amt_credit_sum_debt_mean,
  round(bureau_amt_credit_sum_debt_total, 6) AS bureau_amt_credit_sum_debt_total,
  round(bureau_credit_day_overdue_mean, 6) AS bureau_credit_day_overdue_mean,
  round(bureau_cnt_prolong_mean, 6) AS bureau_cnt_prolong_mean,
  round(bureau_credit_limit_mean, 6) AS bureau_credit_limit_mean,
  round(bb_months_min_mean, 6) AS bb_months_min_mean, round(bb_months_max_mean, 6) AS bb_months_max_mean,
  round(bb_records_mean, 6) AS bb_records_mean, round(bb_late_share_mean, 6) AS bb_late_share_mean,
  round(prev_amt_credit_mean, 6) AS prev_amt_credit_mean, round(prev_amt_credit_max, 6) AS prev_amt_credit_max,
  round(prev_amt_annuity_mean, 6) AS prev_amt_annuity_mean, round(prev_days_decision_max, 6) AS prev_days_decision_max,
  round(prev_rate_down_mean, 6) AS prev_rate_down_mean, round(prev_cnt_payment_mean, 6) AS prev_cnt_payment_mean,
  round(prev_refusal_rate, 6) AS prev_refusal_rate,
  round(pos_months_balance_mean, 6) AS pos_months_balance_mean, round(pos_sk_dpd_max, 6) AS pos_sk_dpd_max,
  round(pos_sk_dpd_mean, 6) AS pos_sk_dpd_mean, round(pos_sk_dpd_def_max, 6) AS pos_sk_dpd_def_max,
  round(pos_cnt_instalment_mean, 6) AS pos_cnt_instalment_mean,
  round(pos_cnt_instalment_future_mean, 6) AS pos_cnt_instalment_future_mean,
  round(cc_amt_balance_mean, 6) AS cc_amt_balance_mean, round(cc_amt_balance_max, 6) AS cc_amt_balance_max,
  round(cc_credit_limit_mean, 6) AS cc_credit_limit_mean,
  round(cc_amt_drawings_current_sum, 6) AS cc_amt_drawings_current_sum,
  round(cc_amt_drawings_current_mean, 6) AS cc_amt_drawings_current_mean,
  round(cc_payment_total_mean, 6) AS cc_payment_total_mean, round(cc_sk_dpd_max, 6) AS cc_sk_dpd_max,
  round(cc_sk_dpd_mean, 6) AS cc_sk_dpd_mean, round(cc_cnt_drawings_mean, 6) AS cc_cnt_drawings_mean,
  round(install_payment_delay_mean, 6) AS install_payment_delay_mean, round(install_dpd_max, 6) AS install_dpd_max,
  round(install_payment_ratio_mean, 6) AS install_payment_ratio_mean,
  round(install_payment_ratio_min, 6) AS install_payment_ratio_min,
  round(install_amt_payment_mean, 6) AS install_amt_payment_mean,
  round(install_amt_instalment_mean, 6) AS install_amt_instalment_mean,
  round(install_late_rate, 6) AS install_late_rate,
  round(fe1_credit_income_ratio, 6) AS fe1_credit_income_ratio, round(fe2_annuity_income_ratio, 6) AS fe2_annuity_income_ratio,
  round(fe3_payment_rate, 6) AS fe3_payment_rate, round(fe4_days_employed_ratio, 6) AS fe4_days_employed_ratio,
  round(fe5_age_years, 6) AS fe5_age_years, round(fe6_income_per_person, 6) AS fe6_income_per_person,
  round(fe7_ext_sources_mean, 6) AS fe7_ext_sources_mean, round(fe8_ext_sources_min, 6) AS fe8_ext_sources_min,
  round(fe9_bureau_overdue_rate, 6) AS fe9_bureau_overdue_rate,
  round(fe10_composite_risk_score, 6) AS fe10_composite_risk_score)
FROM fe
"""


@register("credit_feature_view", "C01,C02,C03,C04,C05,C06,C10,C11,C12,C14,C15,C16,C17,C18,C19,A01,A02,A03,A04,A05,A09,"
          "A10,J01,W05,S02", CREDIT_FEATURE_VIEW_SQL)
def q_credit_feature_view(spark, sf_dir):
    """Credit view stack: registry select → history aggregates (incl. the
    credit → client roll-up of monthly balances) → master join → fe1–fe10."""
    return rounded(build_feature_view(credit_raw_tables(spark, sf_dir)))


@register("credit_feature_matrix", "E01,E02,E19,E20,C27,S15")
def q_credit_matrix(spark, sf_dir):
    """Registry-driven fit on the training split of the credit view, applied to
    train and test: the model input matrix with id, target and split."""
    from credal.plans.credit_matrix import feature_matrix
    from credal.plans.credit_views import credit_registry
    reg = credit_registry()
    view = build_feature_view(credit_raw_tables(spark, sf_dir), reg)
    matrix, _ = feature_matrix(view, reg)
    return rounded(matrix)


@register("registry_validation", "E03,S13,E01")
def q_registry_validation(spark, sf_dir):
    """Columns of the credit feature view unknown to the registry or missing
    from it (case-insensitive), with the registry exported as a table."""
    from credal.plans.credit_views import credit_registry
    from credal.registry import validate_columns
    reg = credit_registry()
    view = build_feature_view(credit_raw_tables(spark, sf_dir), reg)
    issues = validate_columns(spark, reg, view.columns, tables=["application"])
    exported = reg.to_dataframe(spark).where("source_table = 'application'").select(
        F.col("name").alias("column"), F.lit("described").alias("issue"))
    return issues.unionByName(exported)


@register("credit_champion_threshold", "M01,M03,M06,M09,M13,M14,W01")
def q_credit_champion(spark, sf_dir):
    """Raw stand-ins → credit view → registry-driven matrix → exact split →
    models compared by F2 → the champion's cost-optimal threshold (lowest
    10·FN + FP on the 150-point sweep, first on ties)."""
    from credal.operators import evaluate as M
    from credal.plans.credit_matrix import feature_matrix
    from credal.plans.credit_model import champion_and_threshold
    from credal.plans.credit_views import credit_registry
    reg = credit_registry()
    matrix, params = feature_matrix(build_feature_view(credit_raw_tables(spark, sf_dir), reg), reg)
    labelled = matrix.where(F.col("split") == "train").drop("split")
    comparison, curve, _ = champion_and_threshold(labelled, params.feature_names, "target", ["sk_id_curr"])
    best = M.best_threshold(curve).select("model", "threshold", F.col("cost").alias("threshold_cost"),
                                          F.col("f2").alias("threshold_f2"), "fn", "fp")
    return rounded(comparison.join(best, "model", "left"))


@register("score_requests_end_to_end", "M17,C29,C30,D02,S11,T05")
def q_score_requests(spark, sf_dir):
    """Model fitted on the credit matrix; requests in their own field names
    (income, age in years, …) aligned, transformed with the saved parameters,
    scored and decided, then appended to a JSON Lines log and read back."""
    from credal.operators import train as TR
    from credal.plans.credit_matrix import feature_matrix
    from credal.plans.credit_scoring import score_requests
    from credal.plans.credit_views import credit_registry
    from credal.sources import io
    reg = credit_registry()
    matrix, params = feature_matrix(build_feature_view(credit_raw_tables(spark, sf_dir), reg), reg)
    train = matrix.where(F.col("split") == "train")
    model = TR.fit_model(train, params.feature_names, TR.model_catalogue(TR.weighted_rows(train), "target", None)["logistic"])
    # requests: the application rows as a scoring API would send them
    app = application_raw(spark, sf_dir)
    requests = app.select(F.col("sk_id_curr").alias("request_id"), F.col("amt_income_total").alias("income"),
                          "amt_credit", "amt_annuity", (-F.col("days_birth") / 365.0).alias("age"),
                          "ext_source_1", "ext_source_2", "ext_source_3", "code_gender")
    scored = score_requests(requests, params, model, 0.5, "request_id",
                            renames={"income": "amt_income_total", "age": "days_birth"}, day_fields=["days_birth"])
    path = io.scratch_dir(spark, "prediction-log")
    io.append_jsonl(scored, path, probability="probability")
    return spark.read.schema("request_id long, probability double, decision string").json(path)
