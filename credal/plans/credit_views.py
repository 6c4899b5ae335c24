"""The credit feature-view stack as DataFrame functions.

clean (registry select) → one-row-per-client aggregates of the five history
tables, plus the monthly bureau balances rolled up credit → client → master
left join → engineered features fe1–fe10. Output names are the view's column
names. Status counts compare with the *recoded* (lower-case) values, so they
are not constantly zero.

Physical shape: each history table is partially aggregated by
``sk_id_curr`` before its shuffle; the results are hash-partitioned on the
same key, so the master join shuffles the application side once and joins
the already-partitioned aggregates without another exchange.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.functions import clean as C
from credal.operators.aggregate import guarded_rate
from credal.operators.assemble import master_join, union_aligned
from credal.registry import AttributeSpec, FeatureRegistry

KEY = "sk_id_curr"

# Recoding of the status columns (raw → code).
CREDIT_ACTIVE_MAP = {"Active": "active", "Closed": "closed", "Sold": "sold", "Bad debt": "bad_debt"}
CONTRACT_STATUS_MAP = {"Approved": "approved", "Refused": "refused", "Canceled": "canceled",
                       "Unused offer": "unused_offer"}
GENDER_MAP = {"F": "f", "M": "m", "XNA": "xna"}


def _num(name, table, transform="standard"):
    return AttributeSpec(name, table, "numerical", transform=transform, raw_name=name.upper())


def _id(name, table):
    return AttributeSpec(name, table, "identifier", role="identifier", raw_name=name.upper())


def credit_registry() -> FeatureRegistry:
    """Specs of the columns the view stack reads (a subset of the full
    registry: the aggregate inputs and the engineered-feature inputs)."""
    a, b, p, pc, cc, ins = "application", "bureau", "previous_application", "pos_cash", "credit_card", "installments"
    return FeatureRegistry([
        _id("sk_id_curr", a),
        AttributeSpec("target", a, "binary", role="target", raw_name="TARGET"),
        AttributeSpec("code_gender", a, "categorical", encoding="one_hot", raw_name="CODE_GENDER",
                      value_map=GENDER_MAP, unknown_value="unknown"),
        AttributeSpec("name_contract_type", a, "categorical", encoding="one_hot", raw_name="NAME_CONTRACT_TYPE"),
        _num("amt_income_total", a, "log"), _num("amt_credit", a, "log"), _num("amt_annuity", a, "log"),
        _num("days_birth", a), _num("days_employed", a), _num("cnt_fam_members", a, "robust"),
        _num("ext_source_1", a), _num("ext_source_2", a), _num("ext_source_3", a),
        _id("sk_id_curr", b), _id("sk_id_bureau", b),
        AttributeSpec("credit_active", b, "categorical", raw_name="CREDIT_ACTIVE", value_map=CREDIT_ACTIVE_MAP,
                      unknown_value="unknown"),
        _num("days_credit", b), _num("credit_day_overdue", b), _num("amt_credit_sum", b, "log"),
        _num("amt_credit_sum_debt", b), _num("amt_credit_sum_limit", b), _num("cnt_credit_prolong", b),
        _id("sk_id_bureau", "bureau_balance"), _num("months_balance", "bureau_balance"),
        AttributeSpec("status", "bureau_balance", "categorical", raw_name="STATUS"),
        _id("sk_id_curr", p), _id("sk_id_prev", p),
        AttributeSpec("name_contract_status", p, "categorical", raw_name="NAME_CONTRACT_STATUS",
                      value_map=CONTRACT_STATUS_MAP, unknown_value="unknown"),
        _num("amt_credit", p, "log"), _num("amt_annuity", p, "log"), _num("days_decision", p),
        _num("rate_down_payment", p), _num("cnt_payment", p),
        _id("sk_id_curr", pc), _id("sk_id_prev", pc),
        _num("months_balance", pc), _num("sk_dpd", pc), _num("sk_dpd_def", pc), _num("cnt_instalment", pc),
        _num("cnt_instalment_future", pc),
        _id("sk_id_curr", cc), _id("sk_id_prev", cc),
        _num("amt_balance", cc), _num("amt_credit_limit_actual", cc), _num("amt_drawings_current", cc),
        _num("amt_payment_total_current", cc), _num("sk_dpd", cc), _num("cnt_drawings_current", cc),
        _id("sk_id_curr", ins), _id("sk_id_prev", ins),
        _num("days_instalment", ins), _num("days_entry_payment", ins), _num("amt_instalment", ins),
        _num("amt_payment", ins),
    ])


# clean ----------------------------------------------------------------------------
def clean_table(raw: DataFrame, table: str, registry: FeatureRegistry, is_test: bool = False) -> DataFrame:
    """Registry-driven select (identifier cast, target, recode, normalise)."""
    return raw.select(*registry.select_exprs(table, is_test=is_test, columns=raw.columns))


def clean_application(train: DataFrame, test: DataFrame | None, registry: FeatureRegistry) -> DataFrame:
    """W05 + C06 + C10: train and test cleaned, tagged and unioned; the
    365243-day sentinel becomes NULL."""
    parts = [clean_table(train, "application", registry).withColumn("split", F.lit("train"))]
    if test is not None:
        parts.append(clean_table(test, "application", registry, is_test=True).withColumn("split", F.lit("test")))
    app = union_aligned(parts)
    return app.withColumn("days_employed", C.sentinel_to_null("days_employed"))


def clean_installments(raw: DataFrame, registry: FeatureRegistry) -> DataFrame:
    """Installments with payment delay (C12) and payment ratio (C11)."""
    return clean_table(raw, "installments", registry).select(
        "*", C.difference("days_entry_payment", "days_instalment").alias("payment_delay_days"),
        C.guarded_ratio("amt_payment", "amt_instalment").alias("payment_ratio"))


# aggregates (A01–A05) -----------------------------------------------------------------
def agg_bureau(b: DataFrame) -> DataFrame:
    return b.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("bureau_credit_count"),
        F.avg("amt_credit_sum").alias("bureau_amt_credit_sum_mean"),
        F.sum("amt_credit_sum").alias("bureau_amt_credit_sum_total"),
        F.max("days_credit").alias("bureau_days_credit_max"),
        F.min("days_credit").alias("bureau_days_credit_min"),
        F.avg("amt_credit_sum_debt").alias("bureau_amt_credit_sum_debt_mean"),
        F.sum("amt_credit_sum_debt").alias("bureau_amt_credit_sum_debt_total"),
        F.count_if(F.col("credit_active") == "active").alias("bureau_active_credit_count"),
        F.count_if(F.col("credit_active") == "closed").alias("bureau_closed_credit_count"),
        F.count_if(F.col("credit_day_overdue") > 0).alias("bureau_overdue_count"),
        F.avg("credit_day_overdue").alias("bureau_credit_day_overdue_mean"),
        F.avg("cnt_credit_prolong").alias("bureau_cnt_prolong_mean"),
        F.avg("amt_credit_sum_limit").alias("bureau_credit_limit_mean"))


def agg_previous(p: DataFrame) -> DataFrame:
    refused = F.col("name_contract_status") == "refused"
    return p.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("prev_app_count"),
        F.count_if(F.col("name_contract_status") == "approved").alias("prev_approved_count"),
        F.count_if(refused).alias("prev_refused_count"),
        F.count_if(F.col("name_contract_status") == "canceled").alias("prev_canceled_count"),
        F.avg("amt_credit").alias("prev_amt_credit_mean"),
        F.max("amt_credit").alias("prev_amt_credit_max"),
        F.avg("amt_annuity").alias("prev_amt_annuity_mean"),
        F.max("days_decision").alias("prev_days_decision_max"),
        F.avg("rate_down_payment").alias("prev_rate_down_mean"),
        F.avg("cnt_payment").alias("prev_cnt_payment_mean"),
        guarded_rate(refused).alias("prev_refusal_rate"))


def agg_pos_cash(pc: DataFrame) -> DataFrame:
    return pc.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("pos_records_count"),
        F.avg("months_balance").alias("pos_months_balance_mean"),
        F.max("sk_dpd").alias("pos_sk_dpd_max"),
        F.avg("sk_dpd").alias("pos_sk_dpd_mean"),
        F.max("sk_dpd_def").alias("pos_sk_dpd_def_max"),
        F.avg("cnt_instalment").alias("pos_cnt_instalment_mean"),
        F.avg("cnt_instalment_future").alias("pos_cnt_instalment_future_mean"),
        F.count_if(F.col("sk_dpd") > 0).alias("pos_dpd_count"))


def agg_credit_card(cc: DataFrame) -> DataFrame:
    return cc.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("cc_records_count"),
        F.avg("amt_balance").alias("cc_amt_balance_mean"),
        F.max("amt_balance").alias("cc_amt_balance_max"),
        F.avg("amt_credit_limit_actual").alias("cc_credit_limit_mean"),
        F.sum("amt_drawings_current").alias("cc_amt_drawings_current_sum"),
        F.avg("amt_drawings_current").alias("cc_amt_drawings_current_mean"),
        F.avg("amt_payment_total_current").alias("cc_payment_total_mean"),
        F.max("sk_dpd").alias("cc_sk_dpd_max"),
        F.avg("sk_dpd").alias("cc_sk_dpd_mean"),
        F.avg("cnt_drawings_current").alias("cc_cnt_drawings_mean"),
        F.count_if(F.col("sk_dpd") > 0).alias("cc_dpd_count"))


# bureau_balance statuses that mean days past due (0 = on time, C = closed, X = unknown).
LATE_STATUSES = ("1", "2", "3", "4", "5")


def agg_bureau_balance(bb: DataFrame, bureau: DataFrame) -> DataFrame:
    """A09 two-level roll-up of the monthly bureau balances: per bureau credit
    (months min / max, records, share of late statuses), then per client the
    mean over its credits. The monthly table is partially aggregated per
    credit before it meets ``bureau`` (credit → client), so only one row per
    credit takes part in the join."""
    per_credit = bb.groupBy("sk_id_bureau").agg(
        F.min("months_balance").alias("months_min"), F.max("months_balance").alias("months_max"),
        F.count(F.lit(1)).alias("records"), guarded_rate(F.col("status").isin(*LATE_STATUSES)).alias("late_share"))
    owners = bureau.select("sk_id_bureau", KEY)
    return per_credit.join(owners, "sk_id_bureau").groupBy(KEY).agg(
        F.count(F.lit(1)).alias("bb_credit_count"), F.avg("months_min").alias("bb_months_min_mean"),
        F.avg("months_max").alias("bb_months_max_mean"), F.avg("records").alias("bb_records_mean"),
        F.avg("late_share").alias("bb_late_share_mean"))


def agg_installments(ins: DataFrame) -> DataFrame:
    late = F.col("payment_delay_days") > 0
    return ins.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("install_records_count"),
        F.avg("payment_delay_days").alias("install_payment_delay_mean"),
        F.max("payment_delay_days").alias("install_dpd_max"),
        F.count_if(late).alias("install_late_count"),
        F.avg("payment_ratio").alias("install_payment_ratio_mean"),
        F.min("payment_ratio").alias("install_payment_ratio_min"),
        F.avg("amt_payment").alias("install_amt_payment_mean"),
        F.avg("amt_instalment").alias("install_amt_instalment_mean"),
        guarded_rate(late).alias("install_late_rate"))


# features (Appendix A) ----------------------------------------------------------------
def feature_columns() -> list:
    return [
        C.guarded_ratio("amt_credit", "amt_income_total").alias("fe1_credit_income_ratio"),
        C.guarded_ratio(F.col("amt_annuity") * 12, "amt_income_total").alias("fe2_annuity_income_ratio"),
        C.guarded_ratio("amt_annuity", "amt_credit").alias("fe3_payment_rate"),
        C.employment_share("days_employed", "days_birth").alias("fe4_days_employed_ratio"),
        C.age_years("days_birth").alias("fe5_age_years"),
        C.guarded_ratio("amt_income_total", "cnt_fam_members").alias("fe6_income_per_person"),
        C.mean_of_available("ext_source_1", "ext_source_2", "ext_source_3").alias("fe7_ext_sources_mean"),
        C.row_min("ext_source_1", "ext_source_2", "ext_source_3").alias("fe8_ext_sources_min"),
        C.rate_with_default("bureau_overdue_count", "bureau_credit_count").alias("fe9_bureau_overdue_rate"),
        C.composite_score("ext_source_2", "ext_source_3", "bureau_overdue_count",
                          "bureau_credit_count").alias("fe10_composite_risk_score"),
    ]


def build_feature_view(raw: Mapping[str, DataFrame], registry: FeatureRegistry | None = None) -> DataFrame:
    """Raw tables (technical column names) → ``v_features_engineering``.

    ``raw`` keys: application_train, application_test (optional), bureau,
    bureau_balance, previous_application, pos_cash, credit_card,
    installments. A missing history table is skipped (its columns are
    absent), like a missing file.
    """
    reg = registry or credit_registry()
    app = clean_application(raw["application_train"], raw.get("application_test"), reg)
    aggs = []
    if "bureau" in raw:
        bureau = clean_table(raw["bureau"], "bureau", reg)
        aggs.append(agg_bureau(bureau))
        if "bureau_balance" in raw:
            aggs.append(agg_bureau_balance(clean_table(raw["bureau_balance"], "bureau_balance", reg), bureau))
    if "previous_application" in raw:
        aggs.append(agg_previous(clean_table(raw["previous_application"], "previous_application", reg)))
    if "pos_cash" in raw:
        aggs.append(agg_pos_cash(clean_table(raw["pos_cash"], "pos_cash", reg)))
    if "credit_card" in raw:
        aggs.append(agg_credit_card(clean_table(raw["credit_card"], "credit_card", reg)))
    if "installments" in raw:
        aggs.append(agg_installments(clean_installments(raw["installments"], reg)))
    master = master_join(app, aggs, KEY)
    for col in ("bureau_overdue_count", "bureau_credit_count"):
        if col not in master.columns:
            master = master.withColumn(col, F.lit(None).cast("long"))
    return master.select("*", *feature_columns())
