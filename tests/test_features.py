import datetime as dt
import math

import pytest

from denialscope.operators import procedures as PR
from denialscope.operators.features import features_serve_policy, features_wide, model_input
from denialscope.sources.schema import FEATURE_COLUMNS

D = dt.date


def feats(claims_of, **o):
    return features_wide(claims_of(o)).first().asDict()


@pytest.mark.parametrize("svc,sub,lag", [(D(2024, 1, 1), D(2024, 1, 15), 14), (D(2024, 1, 1), D(2024, 1, 1), 0),
                                         (D(2024, 1, 1), D(2024, 5, 1), 121), (D(2024, 6, 1), D(2024, 5, 1), 0)])
def test_submission_lag(claims_of, svc, sub, lag):
    r = feats(claims_of, service_date=svc, submission_date=sub)
    assert r["submission_lag_days"] == lag
    assert r["late_submission"] == int(lag > 90)


def test_missing_submission_date_is_null_then_zero(claims_of):
    f = features_wide(claims_of({"submission_date": None}))
    assert f.first()["submission_lag_days"] is None
    assert model_input(f).first()["submission_lag_days"] == 0


@pytest.mark.parametrize("dx,expected", [("E11.9", 1), ("I10", 1), ("J44.1", 1), ("N18.3", 1),
                                         ("R10.9|E11.65|Z23", 1), ("R10.9|Z23|M54.5", 0), ("", 0), (None, 0)])
def test_chronic(claims_of, dx, expected):
    assert feats(claims_of, diagnosis_codes=dx)["has_chronic_condition"] == expected


@pytest.mark.parametrize("px,expected", [("27447", 1), ("27130", 1), ("99214|27447", 1), ("99213", 0), ("", 0)])
def test_high_cost(claims_of, px, expected):
    assert feats(claims_of, procedure_codes=px)["has_high_cost_procedure"] == expected


@pytest.mark.parametrize("code,cat", [("99213", "evaluation_management"), ("27447", "surgery"),
                                      ("71046", "radiology"), ("85025", "pathology"), ("90834", "medicine"),
                                      ("00000", "other")])
def test_cpt_category(claims_of, code, cat):
    out = PR.categorize(PR.exploded_codes(claims_of({"procedure_codes": code}))).first()
    assert out["category"] == cat


def test_procedure_complexity(claims_of):
    rows = PR.procedure_complexity(claims_of({"procedure_codes": "99213|99214|71046|27447"})).collect()
    got = {r["category"]: r["n_codes"] for r in rows}
    assert got == {"evaluation_management": 2, "radiology": 1, "surgery": 1}


def test_category_flags(claims_of):
    r = feats(claims_of, procedure_codes="99213|71046")
    assert (r["has_eval_mgmt"], r["has_radiology"], r["has_surgery"]) == (1, 1, 0)
    f = PR.category_flags(claims_of({"procedure_codes": "99213|71046"})).first()
    assert (f["has_eval_mgmt"], f["has_radiology"], f["has_surgery"]) == (1, 1, 0)


def test_log_billed(claims_of):
    assert abs(feats(claims_of)["log_billed_amount"] - math.log1p(360)) < 1e-3


@pytest.mark.parametrize("pos,em,inp", [("23", 1, 0), ("21", 0, 1), ("31", 0, 1), ("11", 0, 0)])
def test_pos_flags(claims_of, pos, em, inp):
    r = feats(claims_of, place_of_service=pos)
    assert (r["is_emergency"], r["is_inpatient"]) == (em, inp)


def test_model_input_columns_and_types(claims_of):
    mi = model_input(features_wide(claims_of({})))
    assert mi.columns == ["claim_id", *FEATURE_COLUMNS]
    assert all(t in ("int", "double", "bigint") for c, t in mi.dtypes if c != "claim_id")
    assert mi.count() == 1


def test_model_input_missing_feature_raises(claims_of):
    with pytest.raises(ValueError):
        model_input(claims_of({}))


def test_code_counts_edge_cases(claims_of):
    r = features_wide(claims_of({"diagnosis_codes": "a||"}, {"procedure_codes": " "},
                                {"diagnosis_codes": None, "procedure_codes": None})).orderBy("claim_id").collect()
    assert r[0]["n_diagnosis_codes"] == 3
    assert r[1]["n_procedure_codes"] == 0
    assert (r[2]["n_diagnosis_codes"], r[2]["n_procedure_codes"]) == (0, 0)
    assert r[2]["cost_per_procedure"] == 360.0


def test_ratio_boundaries(claims_of):
    rows = features_wide(claims_of({"billed_amount": 300.0, "allowed_amount": 100.0},
                                   {"billed_amount": 1000.0, "allowed_amount": 100.0},
                                   {"billed_amount": 5000.0, "allowed_amount": 100.0},
                                   {"allowed_amount": 0.0}, {"allowed_amount": None})).orderBy("claim_id").collect()
    assert [r["billed_to_allowed_ratio"] for r in rows] == [3.0, 10.0, 10.0, 1.0, 1.0]


def test_serve_policy(claims_of):
    f = features_serve_policy(claims_of({"place_of_service": "23"})).first()
    assert (f["is_emergency"], f["has_chronic_condition"], f["submission_lag_days"], f["member_age"],
            f["is_male"]) == (1, 1, 12, 47, 1)
    bare = features_serve_policy(claims_of({"place_of_service": None, "member_age": None, "member_gender": None,
                                            "allowed_amount": None})).first()
    assert all(bare[c] is not None for c in FEATURE_COLUMNS)
    assert bare["member_age"] == 50
    assert abs(bare["billed_to_allowed_ratio"] - 1 / 0.65) < 1e-12
    assert bare["provider_historical_denial_rate"] == 0.25


def test_weekend_and_month(claims_of):
    r = feats(claims_of)  # 2024-03-09 is a Saturday
    assert (r["is_weekend_service"], r["service_month"]) == (1, 3)
    r = feats(claims_of, service_date=D(2024, 6, 3))
    assert r["is_weekend_service"] == 0


def test_days_supply(claims_of):
    r = feats(claims_of, claim_type="pharmacy", days_supply=45)
    assert r["days_supply_normalized"] == 0.5
    assert feats(claims_of, days_supply=45)["days_supply_normalized"] == 0.0
