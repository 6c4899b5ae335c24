"""The credit view stack on a hand-made raw fixture (edge cases of FIXTURES §1/§9)."""

import pytest

from credal.plans.credit_matrix import feature_matrix
from credal.plans.credit_views import build_feature_view, credit_registry


@pytest.fixture(scope="module")
def view(spark):
    app_cols = ("sk_id_curr string, target string, code_gender string, name_contract_type string, "
                "amt_income_total string, amt_credit double, amt_annuity double, days_birth double, "
                "days_employed double, cnt_fam_members double, ext_source_1 double, ext_source_2 double, "
                "ext_source_3 double")
    train = spark.createDataFrame([
        ("1", "1", "F", "Cash loans", "1000", 5000.0, 100.0, -10000.0, -2000.0, 2.0, 0.5, None, 0.3),
        ("2", "0", " m ", "Revolving loans", "0", 0.0, 50.0, -12000.0, 365243.0, 0.0, None, None, None),
        ("3", "0", "XNA", "Cash loans", "None", 3000.0, 80.0, 0.0, -100.0, 1.0, 0.2, 0.4, 0.6)], app_cols)
    test = spark.createDataFrame([
        ("4", None, "zz", "Cash loans", "2000", 4000.0, 90.0, -9000.0, -300.0, 3.0, 0.1, 0.9, None)], app_cols)
    bureau = spark.createDataFrame([
        ("1", "10", "Active", 100.0, 0.0, -5.0, 10.0, 1.0, 0.0),
        ("1", "11", "closed ", 300.0, 5.0, -50.0, -20.0, None, 1.0),
        ("3", "12", "Sold", 50.0, 0.0, -7.0, 0.0, 2.0, 0.0)],
        "sk_id_curr string, sk_id_bureau string, credit_active string, amt_credit_sum double, "
        "credit_day_overdue double, days_credit double, amt_credit_sum_debt double, "
        "amt_credit_sum_limit double, cnt_credit_prolong double")
    prev = spark.createDataFrame([
        ("1", "20", "Approved", 1.0, 1.0, -1.0, 0.1, 12.0), ("1", "21", "Refused", 3.0, 2.0, -3.0, None, 6.0)],
        "sk_id_curr string, sk_id_prev string, name_contract_status string, amt_credit double, "
        "amt_annuity double, days_decision double, rate_down_payment double, cnt_payment double")
    inst = spark.createDataFrame([
        ("1", "20", -10.0, -5.0, 100.0, 100.0), ("1", "20", -20.0, -25.0, 0.0, 10.0), ("3", "30", -3.0, 2.0, 50.0, 25.0)],
        "sk_id_curr string, sk_id_prev string, days_instalment double, days_entry_payment double, "
        "amt_instalment double, amt_payment double")
    raw = {"application_train": train, "application_test": test, "bureau": bureau,
           "previous_application": prev, "installments": inst}  # pos_cash / credit_card files "missing"
    return build_feature_view(raw)


def _rows(view):
    return {r.sk_id_curr: r for r in view.collect()}


def test_registry_select_union_and_recodes(view):
    r = _rows(view)
    assert set(r) == {1, 2, 3, 4}
    assert (r[1].split, r[4].split, r[4].target, r[1].target) == ("train", "test", None, 1)
    assert (r[1].code_gender, r[2].code_gender, r[4].code_gender) == ("f", "m", "unknown")
    assert r[1].name_contract_type == "cash loans"
    assert r[3].amt_income_total is None          # "None" token does not parse
    assert r[2].days_employed is None             # 365243 sentinel


def test_history_aggregates(view):
    r = _rows(view)
    assert r[1].bureau_credit_count == 2 and r[1].bureau_active_credit_count == 1
    assert r[1].bureau_closed_credit_count == 1   # recoded value, not the raw 'Closed'
    assert r[1].bureau_overdue_count == 1 and r[1].bureau_amt_credit_sum_total == 400.0
    assert r[1].prev_refused_count == 1 and r[1].prev_refusal_rate == pytest.approx(0.5)
    assert r[1].install_records_count == 2 and r[1].install_late_count == 1   # paid 5 days after due
    assert r[1].install_payment_ratio_min == pytest.approx(1.0)   # the 0-instalment row has no ratio
    assert r[3].install_late_rate == pytest.approx(1.0) and r[3].install_dpd_max == 5.0
    assert r[2].bureau_credit_count is None       # client without history


def test_engineered_features(view):
    r = _rows(view)
    assert r[1].fe1_credit_income_ratio == pytest.approx(5.0)
    assert r[2].fe1_credit_income_ratio is None          # income 0 → guarded
    assert r[1].fe3_payment_rate == pytest.approx(0.02) and r[2].fe3_payment_rate is None
    assert r[1].fe4_days_employed_ratio == pytest.approx(0.2)
    assert r[3].fe4_days_employed_ratio is None          # birth 0
    assert r[1].fe5_age_years == pytest.approx(10000 / 365.25)
    assert r[2].fe6_income_per_person is None            # 0 family members
    assert r[1].fe7_ext_sources_mean == pytest.approx(0.4) and r[2].fe7_ext_sources_mean is None
    assert r[1].fe8_ext_sources_min == pytest.approx(0.3)
    assert r[1].fe9_bureau_overdue_rate == pytest.approx(0.5) and r[2].fe9_bureau_overdue_rate == 0.0
    assert r[2].fe10_composite_risk_score == pytest.approx((0.5 + 0.5 + 0.0) / 3)
    assert r[1].fe10_composite_risk_score == pytest.approx((0.5 + 0.7 + 0.5) / 3)


def test_registry_driven_matrix(spark, view):
    matrix, params = feature_matrix(view, credit_registry(), materialize=False)
    cols = matrix.columns
    assert cols[:3] == ["sk_id_curr", "target", "split"]
    assert "log__amt_credit" in cols and "ohe__code_gender_f" in cols and "robust__cnt_fam_members" in cols
    assert matrix.count() == 4
    assert all(v is not None for r in matrix.collect() for v in r[3:])   # repaired: no missing values


def test_champion_and_threshold(spark):
    import numpy as np
    from credal.operators import evaluate as M
    from credal.plans.credit_model import champion_and_threshold
    rng = np.random.default_rng(4)
    x1, x2 = rng.normal(0, 1, 800), rng.normal(0, 1, 800)
    y = (x1 + 0.3 * x2 + rng.normal(0, 0.7, 800) > 1.0).astype(int)
    df = spark.createDataFrame([(i, float(a), float(b), int(t)) for i, (a, b, t) in enumerate(zip(x1, x2, y))],
                               "id int, f1 double, f2 double, y int")
    comparison, curve, final = champion_and_threshold(df, ["f1", "f2"], "y", ["id"], n_thresholds=40,
                                                      models=("logistic", "decision_tree"))
    rows = comparison.collect()
    champ = [r for r in rows if r.champion][0]
    assert champ.f2 == max(r.f2 for r in rows) and len(rows) == 2
    best = M.best_threshold(curve).first()
    assert best.cost == min(r.cost for r in curve.collect())
    assert final is not None and curve.count() == 40
