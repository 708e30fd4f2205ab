import datetime as dt

import pytest
from pyspark.sql import functions as F

from denialscope.operators import explain as X
from denialscope.operators import history as H
from denialscope.operators.features import features_wide
from denialscope.sources.fixtures import claims
from denialscope.sources.schema import FEATURE_COLUMNS

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small_claims(spark):
    return claims(spark, SF001).cache()


def test_rule_contributions_add_up(small_claims):
    e = X.explain_rules(features_wide(small_claims))
    total = F.col("base_value") + F.col("clip_residual")
    for f in FEATURE_COLUMNS:
        total = total + F.col("c_" + f)
    worst = e.select(F.max(F.abs(total - F.col("prediction")))).first()[0]
    assert worst < 1e-9


def test_linear_contributions_add_up(small_claims):
    f = features_wide(small_claims)
    e = X.explain_linear(f, {"has_surgery": 0.7, "member_age": -0.01}, 0.2)
    total = F.col("base_value")
    for c in FEATURE_COLUMNS:
        total = total + F.col("c_" + c)
    assert e.select(F.max(F.abs(total - F.col("prediction")))).first()[0] < 1e-9


def test_factor_order_ties_and_threshold(spark):
    cols = {f"c_{f}": 0.0 for f in FEATURE_COLUMNS}
    cols.update({"c_submission_lag_days": 0.02, "c_has_surgery": -0.02, "c_is_male": 0.02,
                 "c_member_age": 0.01, "c_has_radiology": -0.011})
    df = spark.createDataFrame([tuple(["x", 0.25, 0.3, *cols.values()])],
                               ["claim_id", "base_value", "prediction", *cols.keys()])
    r = X.explanation_records(df).first()
    assert r["top_risk_factors"] == ["submission_lag_days", "is_male"]  # 0.01 is not > 0.01
    assert r["top_protective_factors"] == ["has_surgery", "has_radiology"]
    w = X.waterfall_top(df, k=3).orderBy("rank").collect()
    # equal |0.02|: higher feature index first (has_surgery 18, is_male 17, lag 0)
    assert [x["feature"] for x in w] == ["has_surgery", "is_male", "submission_lag_days"]


def test_loo_join_equals_window(small_claims):
    a = H.with_loo_rate(small_claims).select("claim_id", "provider_npi", "is_denied", H.RATE)
    b = H.with_loo_rate_window(small_claims).select("claim_id", "provider_npi", "is_denied", H.RATE)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rolling_rate_brute_force(spark, claims_of):
    D = dt.date
    rows = [{"provider_npi": "1000000001", "service_date": D(2024, 1, 1), "is_denied": 1},
            {"provider_npi": "1000000001", "service_date": D(2024, 1, 1), "is_denied": 0},
            {"provider_npi": "1000000001", "service_date": D(2024, 2, 1), "is_denied": 1},
            {"provider_npi": "1000000001", "service_date": D(2024, 3, 31), "is_denied": 0},
            {"provider_npi": "1000000001", "service_date": D(2024, 4, 1), "is_denied": 0},
            {"provider_npi": None, "service_date": D(2024, 4, 1), "is_denied": 1}]
    df = claims_of(*rows)
    got = {r["claim_id"]: r[H.RATE] for r in H.with_rolling_rate(df).collect()}
    local = [(r["provider_npi"], r["service_date"], r["is_denied"]) for r in rows]
    for i, (npi, d, _) in enumerate(local):
        prior = [y for (n2, d2, y) in local if npi is not None and n2 == npi and 1 <= (d - d2).days <= 90]
        exp = sum(prior) / len(prior) if prior else 0.25
        assert got[f"T-{i}"] == pytest.approx(exp)
