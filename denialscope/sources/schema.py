"""Canonical schemas: claims at rest (pipe-coded), claim requests (arrays),
and the ordered model feature list."""

from __future__ import annotations

from pyspark.sql import types as T

# FIXED VALUES — the model's 23 input features, in the reference's order.
FEATURE_COLUMNS: list[str] = [
    "submission_lag_days",
    "log_billed_amount",
    "billed_to_allowed_ratio",
    "has_chronic_condition",
    "has_high_cost_procedure",
    "is_emergency",
    "is_inpatient",
    "provider_historical_denial_rate",
    "n_diagnosis_codes",
    "n_procedure_codes",
    "cost_per_procedure",
    "is_weekend_service",
    "service_month",
    "late_submission",
    "is_pharmacy_claim",
    "is_dental_claim",
    "member_age",
    "is_male",
    "has_surgery",
    "has_radiology",
    "has_pathology",
    "has_eval_mgmt",
    "days_supply_normalized",
]

MODEL_VERSION = "1.2.0"
PREDICTION_THRESHOLD = 0.5
DEFAULT_PROVIDER_RATE = 0.25


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


CLAIMS_SCHEMA = T.StructType([
    _f("claim_id", T.StringType()),
    _f("member_id", T.StringType()),
    _f("provider_npi", T.StringType()),
    _f("claim_type", T.StringType()),
    _f("place_of_service", T.StringType()),
    _f("diagnosis_codes", T.StringType()),
    _f("procedure_codes", T.StringType()),
    _f("billed_amount", T.DoubleType()),
    _f("allowed_amount", T.DoubleType()),
    _f("service_date", T.DateType()),
    _f("submission_date", T.DateType()),
    _f("drug_ndc", T.StringType()),
    _f("days_supply", T.IntegerType()),
    _f("member_age", T.IntegerType()),
    _f("member_gender", T.StringType()),
    _f("provider_specialty", T.StringType()),
    _f("is_denied", T.IntegerType()),
])

CLAIM_COLUMNS = [f.name for f in CLAIMS_SCHEMA.fields]

# Request form: code lists are arrays, no label.
REQUEST_SCHEMA = T.StructType([
    _f("claim_id", T.StringType()),
    _f("member_id", T.StringType()),
    _f("provider_npi", T.StringType()),
    _f("claim_type", T.StringType()),
    _f("place_of_service", T.StringType()),
    _f("diagnosis_codes", T.ArrayType(T.StringType())),
    _f("procedure_codes", T.ArrayType(T.StringType())),
    _f("billed_amount", T.DoubleType()),
    _f("allowed_amount", T.DoubleType()),
    _f("service_date", T.DateType()),
    _f("submission_date", T.DateType()),
    _f("drug_ndc", T.StringType()),
    _f("days_supply", T.IntegerType()),
    _f("member_age", T.IntegerType()),
    _f("member_gender", T.StringType()),
    _f("provider_specialty", T.StringType()),
])

# CSV form: dates as text so malformed values can be quarantined, not thrown.
CLAIMS_CSV_SCHEMA = T.StructType(
    [(_f(f.name, T.StringType()) if isinstance(f.dataType, T.DateType) else f)
     for f in CLAIMS_SCHEMA.fields]
    + [_f("_corrupt_record", T.StringType())]
)
