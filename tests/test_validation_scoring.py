import datetime as dt

import pytest
from pyspark.sql import functions as F

from denialscope.functions import rules as R
from denialscope.functions import validation as V
from denialscope.operators import history as H
from denialscope.operators import scoring as SC
from denialscope.operators import validate as VA
from denialscope.operators.features import features_serve_policy, features_wide
from denialscope.sources.schema import REQUEST_SCHEMA

VALID = ("R-9", "M-31", "5550009998", "medical", "22", ["J44.1", "K21.0"], ["71046"], 410.0,
         305.0, dt.date(2025, 2, 3), dt.date(2025, 2, 20), None, None, None, None, None)
FIELDS = [f.name for f in REQUEST_SCHEMA.fields]


def request(spark, **changes):
    row = list(VALID)
    for k, v in changes.items():
        row[FIELDS.index(k)] = v
    return spark.createDataFrame([tuple(row)], REQUEST_SCHEMA)


def errors(spark, **changes):
    df = request(spark, **changes)
    return VA.annotate(df, F.col("diagnosis_codes"), F.col("procedure_codes")).first()["errors"]


@pytest.mark.parametrize("changes", [{"provider_npi": "12345"}, {"provider_npi": "123456789A"},
                                     {"diagnosis_codes": ["INVALID"]}, {"billed_amount": -100.0},
                                     {"billed_amount": 0.0}, {"diagnosis_codes": []}, {"claim_type": "vision"},
                                     {"provider_npi": "123456789\n"}])
def test_quarantined(spark, changes):
    assert len(errors(spark, **changes)) >= 1


def test_valid_request_and_pharmacy(spark):
    assert errors(spark) == []
    assert errors(spark, claim_type="pharmacy", drug_ndc="00002323301", days_supply=30, procedure_codes=[]) == []


def test_split_normalises(spark):
    df = request(spark, claim_type="MEDICAL", place_of_service=None)
    valid, quarantine = VA.split_claims(df, F.col("diagnosis_codes"), F.col("procedure_codes"))
    r = valid.first()
    assert (r["claim_type"], r["place_of_service"]) == ("medical", "11")
    assert quarantine.count() == 0


def test_batch_of_two_and_size_rule(spark):
    df = request(spark).union(request(spark)).withColumn("batch_id", F.lit(1))
    r = VA.batch_sizes(df, "batch_id").first()
    assert (r["n_claims"], r["batch_ok"]) == (2, True)
    big = spark.range(1001).withColumn("batch_id", F.lit(7))
    assert VA.batch_sizes(big, "batch_id").first()["batch_ok"] is False


def test_dates_rule(spark):
    assert V.MSG_DATES in errors(spark, submission_date=dt.date(2025, 1, 1))


def _p(spark, values):
    return spark.createDataFrame([(v,) for v in values], "p DOUBLE")


def test_confidence_boundaries(spark):
    vals = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
    df = _p(spark, vals)
    b = [r[0] for r in df.select(R.confidence_batch(F.col("p"))).collect()]
    s = [r[0] for r in df.select(R.confidence_serve(F.col("p"))).collect()]
    assert b == [None, "high_approve", "medium", "low", "medium", "high_deny"]
    assert s == ["medium", "low", "low", "low", "medium", "high"]


def test_threshold_exactly_half(spark):
    assert _p(spark, [0.5]).select(R.predicted_denied(F.col("p"))).first()[0] is True


def test_np_round_half_even(spark):
    r = _p(spark, [0.46875, 0.12345, 2.675]).select(R.np_round(F.col("p"), 4), R.np_round(F.col("p"), 2)).collect()
    assert r[0][0] == 0.4688
    assert r[2][1] == round(2.675 * 100) / 100


@pytest.mark.parametrize("lag,term", [(30, 0.0), (31, 0.05), (60, 0.05), (61, 0.15), (90, 0.15), (91, 0.35)])
def test_rule_lag_boundaries(spark, lag, term):
    df = spark.createDataFrame([(lag,)], "submission_lag_days INT")
    assert df.select(R.rule_terms()["lag"]).first()[0] == term


@pytest.mark.parametrize("billed,term", [(5000.0, 0.0), (5000.01, 0.08), (10000.0, 0.08), (10000.01, 0.15)])
def test_rule_billed_boundaries(spark, billed, term):
    df = spark.createDataFrame([(billed,)], "billed_amount DOUBLE")
    assert df.select(R.rule_terms()["billed"]).first()[0] == term


def test_reimbursement(claims_of):
    f = features_wide(claims_of({"allowed_amount": 240.0}, {"allowed_amount": 0.0}, {"allowed_amount": None},
                                {"billed_amount": 20000.0, "submission_date": dt.date(2024, 12, 1)}))
    rows = {r["claim_id"]: r for r in SC.predict_batch(f).collect()}
    assert rows["T-0"]["estimated_reimbursement"] == 240.0
    assert rows["T-1"]["estimated_reimbursement"] == pytest.approx(360 * 0.65)
    assert rows["T-2"]["estimated_reimbursement"] == pytest.approx(360 * 0.65)
    assert rows["T-3"]["predicted_denied"] is True
    assert rows["T-3"]["estimated_reimbursement"] == 0.0


def test_reasons_order_and_fallback(claims_of):
    f = features_serve_policy(claims_of({"submission_date": dt.date(2024, 12, 1), "billed_amount": 20000.0,
                                         "allowed_amount": 1000.0, "procedure_codes": "27447"}))
    r = SC.predict_claims(f).first()
    assert r["denial_reasons"][:2] == [R.REASON_LATE, R.REASON_DELAYED]
    assert R.REASON_PRIOR_AUTH in r["denial_reasons"] and R.REASON_UCR in r["denial_reasons"]
    assert r["model_version"] == "1.2.0"


def test_loo_single_claim_and_null_provider(claims_of):
    df = claims_of({"provider_npi": "1111111111", "is_denied": 1}, {"provider_npi": None, "is_denied": 1},
                   {"provider_npi": "2222222222", "is_denied": 1}, {"provider_npi": "2222222222", "is_denied": 0})
    got = {r["claim_id"]: r[H.RATE] for r in H.with_loo_rate(df).collect()}
    assert got["T-0"] == 0.25 and got["T-1"] == 0.25
    assert got["T-2"] == 0.0 and got["T-3"] == 1.0
    win = {r["claim_id"]: r[H.RATE] for r in H.with_loo_rate_window(df).collect()}
    assert win == got
