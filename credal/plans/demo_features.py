"""Demo queries: the feature-view family on the driver tables."""

from __future__ import annotations

from credal.plans.catalog import register, rounded, table
from credal.plans.customer_features import customer_features

CUSTOMER_FEATURES_SQL = """
WITH lpo AS (
  SELECT l_orderkey AS o_orderkey,
         count(*) AS line_count,
         sum(l_extendedprice * (1.0 - l_discount)) AS line_paid_sum,
         min(CASE WHEN l_extendedprice > 0 THEN l_extendedprice * (1.0 - l_discount) / l_extendedprice END)
           AS line_payment_ratio_min,
         count(*) FILTER (WHERE l_returnflag = 'R') AS line_returned_count,
         max(l_quantity) AS line_quantity_max
  FROM lineitem GROUP BY l_orderkey
), hist AS (
  SELECT o.o_custkey AS c_custkey,
         count(*) AS ord_count,
         avg(o_totalprice) AS ord_totalprice_mean,
         sum(o_totalprice) AS ord_totalprice_total,
         max(o_totalprice) AS ord_totalprice_max,
         min(o_orderdate) AS ord_first_date,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS ord_open_count,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS ord_closed_count,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS ord_urgent_count,
         avg(CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE 0.0 END) AS ord_pending_rate,
         CAST(sum(line_count) AS BIGINT) AS line_count,
         CAST(sum(line_returned_count) AS BIGINT) AS line_returned_count,
         avg(line_paid_sum) AS line_paid_mean,
         min(line_payment_ratio_min) AS line_payment_ratio_min,
         max(line_quantity_max) AS line_quantity_max
  FROM orders o LEFT JOIN lpo USING (o_orderkey)
  GROUP BY o.o_custkey
), m AS (
  SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
         h.ord_count, h.ord_totalprice_mean, h.ord_totalprice_total, h.ord_totalprice_max, h.ord_first_date,
         h.ord_open_count, h.ord_closed_count, h.ord_urgent_count, h.ord_pending_rate, h.line_count,
         h.line_returned_count, h.line_paid_mean, h.line_payment_ratio_min, h.line_quantity_max
  FROM customer c LEFT JOIN hist h ON c.c_custkey = h.c_custkey
)
SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment, ord_count,
       round(ord_totalprice_mean, 6) AS ord_totalprice_mean, round(ord_totalprice_total, 6) AS ord_totalprice_total,
       round(ord_totalprice_max, 6) AS ord_totalprice_max, ord_first_date, ord_open_count, ord_closed_count,
       ord_urgent_count, round(ord_pending_rate, 6) AS ord_pending_rate, line_count, line_returned_count,
       round(line_paid_mean, 6) AS line_paid_mean, round(line_payment_ratio_min, 6) AS line_payment_ratio_min,
       round(line_quantity_max, 6) AS line_quantity_max,
       round(CASE WHEN c_acctbal > 0 THEN ord_totalprice_total / c_acctbal END, 6) AS fe_spend_balance_ratio,
       round(CASE WHEN c_acctbal > 0 THEN ord_totalprice_mean / c_acctbal END, 6) AS fe_order_balance_ratio,
       round(CASE WHEN coalesce(line_count, 0) > 0 THEN coalesce(line_returned_count, 0) / line_count
                  ELSE 0.0 END, 6) AS fe_return_rate,
       round(CASE WHEN (CASE WHEN line_payment_ratio_min IS NOT NULL THEN 1 ELSE 0 END
                        + CASE WHEN ord_pending_rate IS NOT NULL THEN 1 ELSE 0 END) > 0
                  THEN (coalesce(line_payment_ratio_min, 0.0) + coalesce(ord_pending_rate, 0.0))
                       / (CASE WHEN line_payment_ratio_min IS NOT NULL THEN 1 ELSE 0 END
                          + CASE WHEN ord_pending_rate IS NOT NULL THEN 1 ELSE 0 END) END, 6) AS fe_mean_available,
       round(least(line_payment_ratio_min, ord_pending_rate), 6) AS fe_row_min,
       round((coalesce(1.0 - line_payment_ratio_min, 0.5) + coalesce(1.0 - ord_pending_rate, 0.5)
              + coalesce(ord_urgent_count / nullif(ord_count, 0), 0.0)) / 3.0, 6) AS fe_composite_score
FROM m
"""


@register("customer_features", "C11,C16,C17,C18,C19,A01,A09,A10,J01,J03", CUSTOMER_FEATURES_SQL)
def q_customer_features(spark, sf_dir):
    """Flagship feature view: customer ⟕ order history ⟕ line roll-up, with ratios."""
    return rounded(customer_features(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"),
                                     table(spark, sf_dir, "lineitem")))
