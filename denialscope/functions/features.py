"""Column expressions for the 23 model features.

Every feature is a native Catalyst expression (higher-order functions over
code arrays, ``when`` chains, date arithmetic), so a whole feature frame is
one projection inside whole-stage codegen — no Python on the executors.

Two missing-value policies, mirroring the two paths of the reference:

* ``batch`` — table semantics: nulls stay null here and become 0 in
  ``model_input`` (``na.fill(0)`` fills null and NaN).
* ``serve`` — single-claim semantics: missing dates give lag 0 / month 1,
  missing allowed amount is imputed as 65 % of billed, age defaults to 50,
  provider history defaults to 0.25.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources import codes

BLANK_RE = r"^[ \t\n\r\f\v]*$"


def _int(c: Column) -> Column:
    return c.cast("int")


def _flag(c: Column) -> Column:
    """Boolean → 0/1 with null treated as false (pandas comparison semantics)."""
    return F.coalesce(c, F.lit(False)).cast("int")


def clip_upper(x: Column, hi: float) -> Column:
    """``min(x, hi)`` keeping null (Spark ``least`` would skip the null)."""
    return F.when(x.isNull(), F.lit(None)).otherwise(F.least(x, F.lit(hi)))


def clip_range(x: Column, lo: float, hi: float) -> Column:
    return F.when(x.isNull(), F.lit(None)).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def _empty_codes() -> Column:
    return F.array().cast("array<string>")


def dx_array(pipe: Column) -> Column:
    """Pipe-joined diagnosis string → array; null/'' → empty (empty pieces kept)."""
    return F.when(pipe.isNull() | (pipe == ""), _empty_codes()).otherwise(F.split(pipe, r"\|", -1))


def proc_array(pipe: Column) -> Column:
    """Pipe-joined procedure string → array; null/blank → empty."""
    return F.when(pipe.isNull() | pipe.rlike(BLANK_RE), _empty_codes()).otherwise(F.split(pipe, r"\|", -1))


def has_chronic(dx: Column) -> Column:
    prefixes = codes.CHRONIC_CONDITION_PREFIXES

    def any_prefix(code):
        cond = code.startswith(prefixes[0])
        for p in prefixes[1:]:
            cond = cond | code.startswith(p)
        return cond

    return _flag(F.exists(dx, any_prefix))


def _lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def has_any_code(procs: Column, code_list: list[str]) -> Column:
    return _flag(F.arrays_overlap(procs, _lit_array(code_list)))


def has_high_cost(procs: Column) -> Column:
    return has_any_code(procs, codes.HIGH_COST_PROCEDURES)


def has_category(procs: Column, category: str) -> Column:
    return has_any_code(procs, codes.codes_in(category))


def submission_lag(service: Column, submission: Column) -> Column:
    """Days from service to submission, clipped at 0; null if a date is missing."""
    d = F.datediff(submission, service)
    return F.when(d.isNull(), F.lit(None).cast("int")).otherwise(F.greatest(d, F.lit(0)))


def feature_exprs(policy: str = "batch", provider_rate: Column | None = None,
                  dx: Column | None = None, procs: Column | None = None) -> dict[str, Column]:
    """Ordered mapping feature name → expression over a claims frame.

    ``dx`` / ``procs`` default to the pipe-coded columns converted to arrays;
    pass array columns directly for request-form input.
    """
    if policy not in ("batch", "serve"):
        raise ValueError(f"unknown policy {policy!r}")
    serve = policy == "serve"
    billed = F.col("billed_amount")
    allowed = F.nanvl(F.col("allowed_amount"), F.lit(None).cast("double"))
    service, submission = F.col("service_date"), F.col("submission_date")
    ctype, pos = F.col("claim_type"), F.col("place_of_service")
    dx = dx if dx is not None else dx_array(F.col("diagnosis_codes"))
    procs = procs if procs is not None else proc_array(F.col("procedure_codes"))
    if provider_rate is None:
        provider_rate = F.lit(0.25)

    lag = submission_lag(service, submission)
    if serve:
        lag = F.coalesce(lag, F.lit(0))
        eff_allowed = F.when(allowed.isNull() | (allowed == 0), billed * 0.65).otherwise(allowed)
        ratio = F.when(eff_allowed > 0, clip_upper(billed / eff_allowed, 10.0)).otherwise(F.lit(1.0))
    else:
        ratio = F.when(allowed > 0, clip_upper(billed / allowed, 10.0)).otherwise(F.lit(1.0))

    n_dx = F.size(dx)
    n_proc = F.size(procs)
    cost = F.when(n_proc > 0, billed / n_proc).otherwise(billed)
    dow = F.dayofweek(service)  # Sunday=1 … Saturday=7
    month = F.month(service)
    age = F.col("member_age")
    supply = F.col("days_supply")
    if serve:
        month = F.coalesce(month, F.lit(1))
        age = F.coalesce(age, F.lit(50))
        supply = F.coalesce(supply, F.lit(0))

    return {
        "submission_lag_days": lag,
        "log_billed_amount": F.log1p(billed),
        "billed_to_allowed_ratio": ratio,
        "has_chronic_condition": has_chronic(dx),
        "has_high_cost_procedure": has_high_cost(procs),
        "is_emergency": _flag(pos.isin(*codes.EMERGENCY_POS_CODES)),
        "is_inpatient": _flag(pos.isin(*codes.INPATIENT_POS_CODES)),
        "provider_historical_denial_rate": provider_rate,
        "n_diagnosis_codes": n_dx,
        "n_procedure_codes": n_proc,
        "cost_per_procedure": cost,
        "is_weekend_service": _flag(dow.isin(1, 7)),
        "service_month": month,
        "late_submission": _flag(lag > 90),
        "is_pharmacy_claim": _flag(ctype == "pharmacy"),
        "is_dental_claim": _flag(ctype == "dental"),
        "member_age": age,
        "is_male": _flag(F.col("member_gender") == "M"),
        "has_surgery": has_category(procs, "surgery"),
        "has_radiology": has_category(procs, "radiology"),
        "has_pathology": has_category(procs, "pathology"),
        "has_eval_mgmt": has_category(procs, "evaluation_management"),
        "days_supply_normalized": F.when(ctype == "pharmacy", supply / 90.0).otherwise(F.lit(0.0)),
    }
