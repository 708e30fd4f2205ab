"""Claim validation rules as column expressions.

Each rule yields an error message (string) or null; ``validate`` collects
all messages into ``errors ARRAY<STRING>`` so one pass splits valid rows
from quarantined rows — the table form of per-request 422 responses.
Regexes use ``\\z`` and ASCII classes so a trailing newline or a non-ASCII
digit never passes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .features import dx_array, proc_array

# FIXED VALUES — accepted formats and messages of the request validators.
NPI_RE = r"^[0-9]{10}\z"
ICD10_RE = r"^[A-Z][0-9]{2}(\.[0-9]{1,4})?\z"
CPT_RE = r"^([0-9]{5}|[A-Z][0-9]{4})\z"
CLAIM_TYPES = ["medical", "pharmacy", "dental"]
MSG_NPI = "NPI must be exactly 10 digits"
MSG_ICD = "Invalid ICD-10 code: {}. Expected format like E11.9 or I10"
MSG_CPT = "Invalid procedure code: {}. Expected 5-digit CPT or HCPCS format"
MSG_TYPE = "claim_type must be one of {'medical', 'pharmacy', 'dental'}"
MSG_DATES = "submission_date cannot be before service_date"
MSG_DX_EMPTY = "diagnosis_codes must contain at least 1 item"
MSG_BILLED = "billed_amount must be greater than 0"
MSG_ALLOWED = "allowed_amount must be greater than or equal to 0"
MSG_SUPPLY = "days_supply must be greater than or equal to 0"
MSG_AGE = "member_age must be between 0 and 120"
MSG_BATCH = "batch must contain between 1 and 1000 claims"
REQUIRED = ["claim_id", "member_id", "provider_npi", "claim_type", "diagnosis_codes",
            "billed_amount", "service_date"]
DEFAULT_POS = "11"
MAX_BATCH = 1000


def _msg(cond: Column, text) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), text if isinstance(text, Column) else F.lit(text))


def _fmt(template: str, value: Column) -> Column:
    head, tail = template.split("{}")
    return F.concat(F.lit(head), value, F.lit(tail))


def rule_required() -> list[Column]:
    """V7: required fields present."""
    return [_msg(F.col(c).isNull(), f"{c}: field required") for c in REQUIRED]


def rule_npi() -> Column:
    """V1: exactly ten ASCII digits (null is reported by V7)."""
    npi = F.col("provider_npi")
    return _msg(npi.isNotNull() & ~npi.rlike(NPI_RE), MSG_NPI)


def rule_icd10(dx: Column) -> Column:
    """V2: at least one code and every code ICD-10 shaped."""
    bad = F.filter(dx, lambda x: ~x.rlike(ICD10_RE))
    return F.coalesce(
        _msg(F.col("diagnosis_codes").isNotNull() & (F.size(dx) == 0), MSG_DX_EMPTY),
        _msg(F.size(bad) > 0, _fmt(MSG_ICD, F.get(bad, 0))))


def rule_cpt(px: Column) -> Column:
    """V3: every procedure code is 5 digits or letter + 4 digits (may be empty)."""
    bad = F.filter(px, lambda x: ~x.rlike(CPT_RE))
    return _msg(F.size(bad) > 0, _fmt(MSG_CPT, F.get(bad, 0)))


def rule_claim_type() -> Column:
    """V4: lower-cased type is one of three."""
    t = F.col("claim_type")
    return _msg(t.isNotNull() & ~F.lower(t).isin(*CLAIM_TYPES), MSG_TYPE)


def rule_dates() -> Column:
    """V5: submission not before service (only when both present)."""
    return _msg(F.col("submission_date") < F.col("service_date"), MSG_DATES)


def rule_ranges() -> list[Column]:
    """V6: numeric bounds (nulls allowed except billed, which V7 covers)."""
    return [
        _msg(F.col("billed_amount") <= 0, MSG_BILLED),
        _msg(F.col("allowed_amount") < 0, MSG_ALLOWED),
        _msg(F.col("days_supply") < 0, MSG_SUPPLY),
        _msg((F.col("member_age") < 0) | (F.col("member_age") > 120), MSG_AGE),
    ]


def error_list(dx: Column | None = None, px: Column | None = None) -> Column:
    """V8: all rule messages, nulls removed, in rule order."""
    dx = dx if dx is not None else dx_array(F.col("diagnosis_codes"))
    px = px if px is not None else proc_array(F.col("procedure_codes"))
    msgs = [*rule_required(), rule_npi(), rule_icd10(dx), rule_cpt(px), rule_claim_type(),
            rule_dates(), *rule_ranges()]
    return F.filter(F.array(*msgs), lambda x: x.isNotNull())
