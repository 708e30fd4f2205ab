"""DuckDB SQL fragments for the oracle queries.

Each oracle is ``WITH <claims CTEs>, <feature CTEs> SELECT …`` over the
driver's pre-registered ``lineitem`` / ``orders`` views. Code lists are
rendered from the same Python constants the Spark expressions use.
"""

from __future__ import annotations

from ..functions.rules import (REASON_DELAYED, REASON_FALLBACK, REASON_INPATIENT, REASON_LATE,
                               REASON_PRIOR_AUTH, REASON_PROVIDER, REASON_RATIO, REASON_UCR)
from ..sources import codes
from ..sources.fixtures import claims_cte
from ..sources.schema import FEATURE_COLUMNS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def sql_in(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


RAW_COLS = ["claim_id", "member_id", "provider_npi", "claim_type", "place_of_service",
            "diagnosis_codes", "procedure_codes", "billed_amount", "allowed_amount",
            "service_date", "submission_date", "drug_ndc", "days_supply", "member_gender",
            "provider_specialty", "is_denied"]

BLANK = "'^[ \t\n\r\f\v]*$'"

CHRONIC = " OR ".join(f"starts_with(x, {q(p)})" for p in codes.CHRONIC_CONDITION_PREFIXES)

# Provider stats and leave-one-out rate over the claims CTE.
PROV_CTE = """prov AS (
  SELECT provider_npi, CAST(SUM(is_denied) AS BIGINT) AS total_denied, COUNT(is_denied) AS total_claims
  FROM claims WHERE provider_npi IS NOT NULL GROUP BY provider_npi
)"""

LOO_EXPR = ("least(greatest(coalesce(CAST(p.total_denied - c.is_denied AS DOUBLE) / "
            "NULLIF(CAST(p.total_claims - 1 AS DOUBLE), 0), 0.25), 0.0), 1.0)")

HIST_EXPR = ("least(greatest(coalesce(CAST(p.total_denied AS DOUBLE) / "
             "NULLIF(CAST(p.total_claims AS DOUBLE), 0), 0.25), 0.0), 1.0)")


# Point-in-time rate: claims of the provider in the 90 days before the day.
ROLL_CTE = """daily AS (
  SELECT provider_npi, CAST(service_date - DATE '1970-01-01' AS BIGINT) AS day,
         CAST(SUM(is_denied) AS BIGINT) AS denied, COUNT(is_denied) AS n
  FROM claims WHERE provider_npi IS NOT NULL AND service_date IS NOT NULL
  GROUP BY ALL
), roll AS (
  SELECT provider_npi, day,
    CAST(SUM(denied) OVER w AS DOUBLE) / NULLIF(CAST(SUM(n) OVER w AS DOUBLE), 0) AS r
  FROM daily
  WINDOW w AS (PARTITION BY provider_npi ORDER BY day RANGE BETWEEN 90 PRECEDING AND 1 PRECEDING)
)"""


def arr_cte(src: str = "claims", rate: str = "loo") -> str:
    """Code arrays, clipped lag and provider rate: ``loo`` (leave-one-out over
    ``claims``), ``hist`` (full-history rate from ``claims``), ``roll`` (90 days
    before the claim), ``default`` (0.25)."""
    rate_sql = {"loo": LOO_EXPR, "hist": HIST_EXPR, "roll": "coalesce(rl.r, 0.25)", "default": "CAST(0.25 AS DOUBLE)"}[rate]
    roll = (" LEFT JOIN roll rl ON c.provider_npi = rl.provider_npi "
            "AND CAST(c.service_date - DATE '1970-01-01' AS BIGINT) = rl.day" if rate == "roll" else "")
    return f"""arr AS (
  SELECT c.*, {rate_sql} AS prate,
    CASE WHEN c.diagnosis_codes IS NULL OR c.diagnosis_codes = '' THEN []::VARCHAR[]
         ELSE string_split(c.diagnosis_codes, '|') END AS dx,
    CASE WHEN c.procedure_codes IS NULL OR regexp_matches(c.procedure_codes, {BLANK}) THEN []::VARCHAR[]
         ELSE string_split(c.procedure_codes, '|') END AS px,
    CASE WHEN c.submission_date IS NULL OR c.service_date IS NULL THEN NULL
         ELSE greatest(CAST(c.submission_date - c.service_date AS INT), 0) END AS lag
  FROM {src} c LEFT JOIN prov p ON c.provider_npi = p.provider_npi{roll}
)"""


ARR_CTE = arr_cte()


def _cat(cat: str) -> str:
    return f"CAST(list_has_any(px, {sql_list(codes.codes_in(cat))}) AS INT)"


def feature_sql(policy: str = "batch") -> dict[str, str]:
    """Feature name → DuckDB expression over the ``arr`` CTE."""
    serve = policy == "serve"
    if serve:
        lag = "coalesce(lag, 0)"
        eff = "(CASE WHEN allowed_amount IS NULL OR allowed_amount = 0 THEN billed_amount * 0.65 ELSE allowed_amount END)"
        ratio = f"CASE WHEN {eff} > 0 THEN least(billed_amount / {eff}, 10.0) ELSE 1.0 END"
        month = "coalesce(CAST(month(service_date) AS INT), 1)"
        age = "coalesce(member_age, 50)"
        supply = "coalesce(days_supply, 0)"
        rate = "prate"
    else:
        lag = "lag"
        ratio = "CASE WHEN allowed_amount > 0 THEN least(billed_amount / allowed_amount, 10.0) ELSE 1.0 END"
        month = "CAST(month(service_date) AS INT)"
        age = "member_age"
        supply = "days_supply"
        rate = "prate"
    return {
        "submission_lag_days": lag,
        "log_billed_amount": "ln(1 + billed_amount)",
        "billed_to_allowed_ratio": ratio,
        "has_chronic_condition": f"CAST(len(list_filter(dx, lambda x: {CHRONIC})) > 0 AS INT)",
        "has_high_cost_procedure": f"CAST(list_has_any(px, {sql_list(codes.HIGH_COST_PROCEDURES)}) AS INT)",
        "is_emergency": f"CAST(coalesce(place_of_service IN {sql_in(codes.EMERGENCY_POS_CODES)}, false) AS INT)",
        "is_inpatient": f"CAST(coalesce(place_of_service IN {sql_in(codes.INPATIENT_POS_CODES)}, false) AS INT)",
        "provider_historical_denial_rate": rate,
        "n_diagnosis_codes": "CAST(len(dx) AS INT)",
        "n_procedure_codes": "CAST(len(px) AS INT)",
        "cost_per_procedure": "CASE WHEN len(px) > 0 THEN billed_amount / len(px) ELSE billed_amount END",
        "is_weekend_service": "CAST(coalesce(isodow(service_date) IN (6, 7), false) AS INT)",
        "service_month": month,
        "late_submission": f"CAST(coalesce({lag} > 90, false) AS INT)",
        "is_pharmacy_claim": "CAST(coalesce(claim_type = 'pharmacy', false) AS INT)",
        "is_dental_claim": "CAST(coalesce(claim_type = 'dental', false) AS INT)",
        "member_age": age,
        "is_male": "CAST(coalesce(member_gender = 'M', false) AS INT)",
        "has_surgery": _cat("surgery"),
        "has_radiology": _cat("radiology"),
        "has_pathology": _cat("pathology"),
        "has_eval_mgmt": _cat("evaluation_management"),
        "days_supply_normalized": f"CASE WHEN claim_type = 'pharmacy' THEN {supply} / 90.0 ELSE 0.0 END",
    }


def feat_cte(name: str = "feat", policy: str = "batch") -> str:
    cols = ", ".join(RAW_COLS)
    fx = ",\n    ".join(f"{e} AS {n}" for n, e in feature_sql(policy).items())
    return f"{name} AS (\n  SELECT {cols},\n    {fx}\n  FROM arr\n)"


def mi_cte(name: str = "mi", src: str = "feat") -> str:
    """Model input: claim_id, label and the 23 features with null → 0."""
    fx = ", ".join(f"coalesce({c}, 0) AS {c}" for c in FEATURE_COLUMNS)
    return f"{name} AS (SELECT claim_id, is_denied, {fx} FROM {src})"


def D(x) -> str:
    """DOUBLE literal (DuckDB reads bare decimals as DECIMAL)."""
    return f"CAST({x!r} AS DOUBLE)"


def np_round_sql(expr: str, decimals: int) -> str:
    f = D(float(10 ** decimals))
    return f"(round_even(({expr}) * {f}, 0) / {f})"


def rule_terms_sql(src_alias: str = "") -> dict[str, str]:
    """Rule-scorecard terms as DOUBLE expressions, in the Spark term order."""
    a = src_alias
    lag = f"coalesce({a}submission_lag_days, 0)"
    z = D(0.0)
    return {
        "base": D(0.1),
        "lag": f"CASE WHEN {lag} > 90 THEN {D(0.35)} WHEN {lag} > 60 THEN {D(0.15)} WHEN {lag} > 30 THEN {D(0.05)} ELSE {z} END",
        "billed": f"CASE WHEN {a}billed_amount > 10000 THEN {D(0.15)} WHEN {a}billed_amount > 5000 THEN {D(0.08)} ELSE {z} END",
        "provider": f"coalesce({a}provider_historical_denial_rate, {z}) * {D(0.3)}",
        "chronic": f"CASE WHEN {a}has_chronic_condition = 1 THEN {D(0.05)} ELSE {z} END",
        "emergency": f"CASE WHEN {a}place_of_service = '23' THEN {D(-0.1)} ELSE {z} END",
        "pharmacy": f"CASE WHEN {a}claim_type = 'pharmacy' THEN {D(0.03)} ELSE {z} END",
        "inpatient": f"CASE WHEN {a}place_of_service = '21' THEN {D(0.08)} ELSE {z} END",
        "surgery": f"CASE WHEN {a}has_surgery = 1 THEN {D(0.1)} ELSE {z} END",
    }


def rule_sql(src_alias: str = "") -> str:
    """Pre-clip rule score over a feature row: DOUBLE terms added left to
    right in the same order as the Spark expression (bit-identical sums)."""
    return " + ".join(f"({t})" for t in rule_terms_sql(src_alias).values())


def scored_cte(name: str = "sc", src: str = "feat") -> str:
    return (f"{name} AS (SELECT *, least(greatest({rule_sql()}, {D(0.02)}), {D(0.95)}) AS p_denial "
            f"FROM {src})")


def base_ctes(policy: str = "batch", scored: bool = False, mi: bool = False,
              src: str = "claims", rate: str | None = None, pre: tuple[str, ...] = ()) -> str:
    """claims → [pre CTEs] → provider stats → arrays/rate (from ``src``) →
    features [→ model input] [→ rule score]."""
    rate = rate or ("loo" if policy == "batch" else "default")
    parts = [claims_cte(), *pre, PROV_CTE, *([ROLL_CTE] if rate == "roll" else []), arr_cte(src, rate), feat_cte("feat", policy)]
    if mi:
        parts.append(mi_cte())
    if scored:
        parts.append(scored_cte())
    return ",\n".join(parts)


def with_(*extra: str, policy: str = "batch", scored: bool = False, mi: bool = False,
          src: str = "claims", rate: str | None = None, pre: tuple[str, ...] = ()) -> str:
    """``WITH`` clause of all base CTEs plus ``extra`` ones."""
    return "WITH " + ",\n".join([base_ctes(policy, scored, mi, src, rate, pre), *extra]) + "\n"


CONF_BATCH = ("CASE WHEN p_denial > 0 AND p_denial <= 0.2 THEN 'high_approve' "
              "WHEN p_denial > 0.2 AND p_denial <= 0.4 THEN 'medium' "
              "WHEN p_denial > 0.4 AND p_denial <= 0.6 THEN 'low' "
              "WHEN p_denial > 0.6 AND p_denial <= 0.8 THEN 'medium' "
              "WHEN p_denial > 0.8 AND p_denial <= 1.0 THEN 'high_deny' END")

CONF_SERVE = ("CASE WHEN p_denial > 0.8 THEN 'high' WHEN p_denial > 0.6 OR p_denial < 0.2 THEN 'medium' "
              "ELSE 'low' END")

REIMB_BATCH = ("CASE WHEN p_denial >= 0.5 THEN 0.0 WHEN allowed_amount > 0 THEN allowed_amount "
               "ELSE billed_amount * 0.65 END")

REASONS_LIST = (
    "list_filter([" + ", ".join([
        f"CASE WHEN late_submission = 1 THEN {q(REASON_LATE)} END",
        f"CASE WHEN submission_lag_days > 60 THEN {q(REASON_DELAYED)} END",
        f"CASE WHEN has_high_cost_procedure = 1 AND p_denial > 0.5 THEN {q(REASON_PRIOR_AUTH)} END",
        f"CASE WHEN log_billed_amount > ln(1 + 10000.0) THEN {q(REASON_UCR)} END",
        f"CASE WHEN billed_to_allowed_ratio > 3.0 THEN {q(REASON_RATIO)} END",
        f"CASE WHEN provider_historical_denial_rate > 0.4 THEN {q(REASON_PROVIDER)} END",
        f"CASE WHEN is_inpatient = 1 AND p_denial > 0.5 THEN {q(REASON_INPATIENT)} END",
    ]) + "], lambda x: x IS NOT NULL)"
)

REASONS = (f"CASE WHEN len({REASONS_LIST}) = 0 AND p_denial > 0.5 THEN [{q(REASON_FALLBACK)}] "
           f"ELSE {REASONS_LIST} END")
