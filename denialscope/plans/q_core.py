"""Registered queries: features, history, validation, codes, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import validation as V
from ..functions.features import dx_array, proc_array
from ..operators import features as FE
from ..operators import history as H
from ..operators import procedures as PR
from ..operators import scoring as SC
from ..operators import validate as VA
from ..sources import codes
from ..sources.fixtures import claims
from ..sources.schema import FEATURE_COLUMNS
from . import sqlparts as S
from .registry import register


def wide(spark, d, history="loo", policy="batch"):
    return FE.features_wide(claims(spark, d), provider_history=history, policy=policy)


def mi(spark, d):
    return FE.model_input(wide(spark, d), keep=("claim_id", "is_denied"))


# --------------------------------------------------------------------------
# One query per feature (model-input form: null/NaN → 0)
# --------------------------------------------------------------------------
def _feature_query(name):
    def q(spark, d):
        return mi(spark, d).select("claim_id", name)
    return q


for _name in FEATURE_COLUMNS:
    register(f"f_{_name}",
             S.with_(mi=True) + f"SELECT claim_id, {_name} FROM mi")(_feature_query(_name))

_WIDE_COLS = S.RAW_COLS + FEATURE_COLUMNS


# Integer columns that hold nulls are exported as DOUBLE in both engines.
_NULLABLE_INTS = ("submission_lag_days", "member_age", "service_month", "days_supply", "is_denied")


def _wide_sql_col(c):
    if c in ("service_date", "submission_date"):
        return f"CAST({c} AS VARCHAR) AS {c}"
    if c in _NULLABLE_INTS:
        return f"CAST({c} AS DOUBLE) AS {c}"
    return c


@register("features_wide", S.with_() + "SELECT " + ", ".join(_wide_sql_col(c) for c in _WIDE_COLS) + " FROM feat")
def q_features_wide(spark, d):
    """raw columns + 23 features (nulls kept)."""
    return wide(spark, d).select(*[F.col(c).cast("double").alias(c) if c in _NULLABLE_INTS else c
                                   for c in _WIDE_COLS])


@register("model_input", S.with_(mi=True) + "SELECT claim_id, " + ", ".join(FEATURE_COLUMNS) + " FROM mi")
def q_model_input(spark, d):
    """23 ordered features, null → 0."""
    return FE.model_input(wide(spark, d))


@register("features_serve_policy",
          S.with_(policy="serve") + "SELECT claim_id, " + ", ".join(FEATURE_COLUMNS) + " FROM feat")
def q_features_serve(spark, d):
    """serving-path defaults as a table job."""
    return FE.features_serve_policy(claims(spark, d)).select("claim_id", *FEATURE_COLUMNS)


# --------------------------------------------------------------------------
# Provider history: A1, A2, J1, W1, W2, J8
# --------------------------------------------------------------------------
@register("agg_provider", "WITH " + S.claims_cte() + ",\n" + S.PROV_CTE + "\nSELECT * FROM prov")
def q_agg_provider(spark, d):
    """A1: denied sum and claim count per provider."""
    return H.provider_stats(claims(spark, d))


_LOO_SQL = S.with_() + "SELECT claim_id, provider_historical_denial_rate FROM feat"


@register("agg_loo_rate", _LOO_SQL)
def q_agg_loo(spark, d):
    """A2: leave-one-out rate per claim."""
    return H.with_loo_rate(claims(spark, d)).select("claim_id", H.RATE)


@register("join_provider_stats",
          "WITH " + S.claims_cte() + ",\n" + S.PROV_CTE +
          "\nSELECT c.claim_id, c.provider_npi, CAST(p.total_denied AS DOUBLE) AS total_denied, "
          "CAST(p.total_claims AS DOUBLE) AS total_claims "
          "FROM claims c LEFT JOIN prov p ON c.provider_npi = p.provider_npi")
def q_join_provider_stats(spark, d):
    """Provider stats left-joined back to claims (null NPI → no match)."""
    c = claims(spark, d)
    return (c.select("claim_id", "provider_npi")
            .join(H.provider_stats(c), on="provider_npi", how="left")
            .select("claim_id", "provider_npi", F.col("total_denied").cast("double").alias("total_denied"),
                    F.col("total_claims").cast("double").alias("total_claims")))


@register("win_loo_rate", _LOO_SQL)
def q_win_loo(spark, d):
    """The same rate computed with a window."""
    return H.with_loo_rate_window(claims(spark, d)).select("claim_id", H.RATE)


_ROLL_SQL = ("WITH " + S.claims_cte() + ",\n" + S.ROLL_CTE + """
SELECT c.claim_id, coalesce(r.r, 0.25) AS provider_historical_denial_rate
FROM claims c LEFT JOIN roll r
  ON c.provider_npi = r.provider_npi AND CAST(c.service_date - DATE '1970-01-01' AS BIGINT) = r.day""")


@register("win_provider_rate_90d", _ROLL_SQL)
def q_win_rolling(spark, d):
    """Point-in-time 90-day provider denial rate (pre-aggregated by day)."""
    return H.with_rolling_rate(claims(spark, d)).select("claim_id", H.RATE)


_HIST_SPLIT = "DATE '2000-01-01'"


@register("join_provider_history", "WITH " + S.claims_cte() + f""",
hist AS (SELECT provider_npi, CAST(SUM(is_denied) AS DOUBLE) / COUNT(is_denied) AS hr
         FROM claims WHERE service_date < {_HIST_SPLIT} AND provider_npi IS NOT NULL GROUP BY provider_npi)
SELECT c.claim_id, least(greatest(coalesce(h.hr, 0.25), 0.0), 1.0) AS provider_historical_denial_rate
FROM claims c LEFT JOIN hist h ON c.provider_npi = h.provider_npi
WHERE c.service_date >= {_HIST_SPLIT}""")
def q_join_history(spark, d):
    """Score later claims with provider rates from an earlier labelled history."""
    c = claims(spark, d)
    hist = c.where(F.col("service_date") < F.lit("2000-01-01").cast("date"))
    new = c.where(F.col("service_date") >= F.lit("2000-01-01").cast("date"))
    return H.with_history_rate(new, hist).select("claim_id", H.RATE)


# --------------------------------------------------------------------------
# Validation V1–V9
# --------------------------------------------------------------------------
def _dx_sql():
    return ("CASE WHEN diagnosis_codes IS NULL OR diagnosis_codes = '' THEN []::VARCHAR[] "
            "ELSE string_split(diagnosis_codes, '|') END")


def _px_sql():
    return (f"CASE WHEN procedure_codes IS NULL OR regexp_matches(procedure_codes, {S.BLANK}) "
            "THEN []::VARCHAR[] ELSE string_split(procedure_codes, '|') END")


def _msg_sql(cond, text):
    return f"CASE WHEN coalesce({cond}, false) THEN {text} END"


def _fmt_sql(template, value):
    head, tail = template.split("{}")
    return f"concat({S.q(head)}, {value}, {S.q(tail)})"


_V_NPI = _msg_sql(f"provider_npi IS NOT NULL AND NOT regexp_full_match(provider_npi, '[0-9]{{10}}')",
                  S.q(V.MSG_NPI))
_BAD_DX = "list_filter(dx, lambda x: NOT regexp_full_match(x, '[A-Z][0-9]{2}(\\.[0-9]{1,4})?'))"
_V_ICD = ("coalesce(" + _msg_sql("diagnosis_codes IS NOT NULL AND len(dx) = 0", S.q(V.MSG_DX_EMPTY)) + ", "
          + _msg_sql(f"len({_BAD_DX}) > 0", _fmt_sql(V.MSG_ICD, f"{_BAD_DX}[1]")) + ")")
_BAD_PX = "list_filter(px, lambda x: NOT regexp_full_match(x, '[0-9]{5}|[A-Z][0-9]{4}'))"
_V_CPT = _msg_sql(f"len({_BAD_PX}) > 0", _fmt_sql(V.MSG_CPT, f"{_BAD_PX}[1]"))
_V_TYPE = _msg_sql(f"claim_type IS NOT NULL AND lower(claim_type) NOT IN {S.sql_in(V.CLAIM_TYPES)}",
                   S.q(V.MSG_TYPE))
_V_DATES = _msg_sql("submission_date < service_date", S.q(V.MSG_DATES))
_V_RANGES = [_msg_sql("billed_amount <= 0", S.q(V.MSG_BILLED)),
             _msg_sql("allowed_amount < 0", S.q(V.MSG_ALLOWED)),
             _msg_sql("days_supply < 0", S.q(V.MSG_SUPPLY)),
             _msg_sql("member_age < 0 OR member_age > 120", S.q(V.MSG_AGE))]
_V_REQ = [_msg_sql(f"{c} IS NULL", S.q(f"{c}: field required")) for c in V.REQUIRED]
_V_ALL = "list_filter([" + ", ".join([*_V_REQ, _V_NPI, _V_ICD, _V_CPT, _V_TYPE, _V_DATES, *_V_RANGES]) \
    + "], lambda x: x IS NOT NULL)"

_VCLAIMS = ("WITH " + S.claims_cte() + f",\nva AS (SELECT *, {_dx_sql()} AS dx, {_px_sql()} AS px FROM claims)\n")


def _rule_query(fn_expr):
    def q(spark, d):
        c = claims(spark, d)
        dx, px = dx_array(F.col("diagnosis_codes")), proc_array(F.col("procedure_codes"))
        return c.select("claim_id", fn_expr(dx, px).alias("error"))
    return q


for _key, _spark_rule, _sql_rule in [
    ("v_npi", lambda dx, px: V.rule_npi(), _V_NPI),
    ("v_icd10", lambda dx, px: V.rule_icd10(dx), _V_ICD),
    ("v_cpt", lambda dx, px: V.rule_cpt(px), _V_CPT),
    ("v_claim_type", lambda dx, px: V.rule_claim_type(), _V_TYPE),
    ("v_dates", lambda dx, px: V.rule_dates(), _V_DATES),
    ("v_ranges", lambda dx, px: F.array_join(F.filter(F.array(*V.rule_ranges()), lambda x: x.isNotNull()), "|"),
     "array_to_string(list_filter([" + ", ".join(_V_RANGES) + "], lambda x: x IS NOT NULL), '|')"),
    ("v_required", lambda dx, px: F.array_join(F.filter(F.array(*V.rule_required()), lambda x: x.isNotNull()), "|"),
     "array_to_string(list_filter([" + ", ".join(_V_REQ) + "], lambda x: x IS NOT NULL), '|')"),
]:
    register(_key, _VCLAIMS + f"SELECT claim_id, {_sql_rule} AS error FROM va")(_rule_query(_spark_rule))


@register("validate_claims", _VCLAIMS + f"""SELECT claim_id, array_to_string({_V_ALL}, '|') AS errors,
  len({_V_ALL}) = 0 AS is_valid,
  CASE WHEN len({_V_ALL}) = 0 THEN lower(claim_type) ELSE claim_type END AS claim_type,
  CASE WHEN len({_V_ALL}) = 0 THEN coalesce(place_of_service, '11') ELSE place_of_service END AS place_of_service
FROM va""")
def q_validate(spark, d):
    """V8: every row with its error list; valid rows normalised."""
    a = VA.annotate(claims(spark, d))
    norm = F.col("is_valid")
    return a.select("claim_id", "errors", "is_valid",
                    F.when(norm, F.lower("claim_type")).otherwise(F.col("claim_type")).alias("claim_type"),
                    F.when(norm, F.coalesce("place_of_service", F.lit("11")))
                    .otherwise(F.col("place_of_service")).alias("place_of_service"))


@register("v_batch_size", "WITH " + S.claims_cte() + """
SELECT CAST(service_date AS VARCHAR) AS service_date, COUNT(*) AS n_claims,
       COUNT(*) BETWEEN 1 AND 1000 AS batch_ok
FROM claims GROUP BY service_date""")
def q_batch_size(spark, d):
    """V9: daily batches (by service date) checked against the 1..1000 bound."""
    return VA.batch_sizes(claims(spark, d), "service_date").select("service_date", "n_claims", "batch_ok")


# --------------------------------------------------------------------------
# Lookups and codes: P1, P2, P4, P5, P6, J2, J3, J5, A13, A14
# --------------------------------------------------------------------------
LOOKUP_ID_SQL = "(SELECT min(claim_id) FROM claims WHERE claim_type = 'dental')"


@register("lookup_exact", "WITH " + S.claims_cte() +
          f"\nSELECT claim_id, claim_type, billed_amount, is_denied FROM claims WHERE claim_id = {LOOKUP_ID_SQL}")
def q_lookup_exact(spark, d):
    """Exact claim-id match (the id is looked up from the data itself)."""
    c = claims(spark, d)
    target = c.where("claim_type = 'dental'").agg(F.min("claim_id").alias("t"))
    return (c.join(F.broadcast(target), c.claim_id == target.t, "left_semi")
            .select("claim_id", "claim_type", "billed_amount", "is_denied"))


_PARTIAL = "-1616-"


@register("lookup_partial", "WITH " + S.claims_cte() + f"""
SELECT claim_id, claim_type, billed_amount, is_denied FROM claims
WHERE coalesce(regexp_matches(claim_id, {S.q(_PARTIAL)}), false)
ORDER BY claim_id LIMIT 10""")
def q_lookup_partial(spark, d):
    """Regex 'contains' search, first 10 by claim id (top-k is the feature)."""
    c = claims(spark, d)
    return (c.where(F.coalesce(F.col("claim_id").rlike(_PARTIAL), F.lit(False)))
            .select("claim_id", "claim_type", "billed_amount", "is_denied")
            .orderBy("claim_id").limit(10))


_EXPLODE_SQL = ("WITH " + S.claims_cte() + f""",
ex AS (SELECT claim_id, unnest(px) AS cpt_code, CAST(generate_subscripts(px, 1) - 1 AS INT) AS pos
       FROM (SELECT claim_id, {_px_sql()} AS px FROM claims)),
dim AS (SELECT * FROM (VALUES {", ".join(f"({S.q(k)}, {S.q(v)}, {str(k in codes.HIGH_COST_PROCEDURES).upper()})"
                                          for k, v in codes.CPT_TO_CATEGORY.items())})
        t(cpt_code, category, is_high_cost))
""")


@register("cpt_category", _EXPLODE_SQL +
          "SELECT ex.claim_id, ex.pos, ex.cpt_code, coalesce(dim.category, 'other') AS category "
          "FROM ex LEFT JOIN dim ON ex.cpt_code = dim.cpt_code")
def q_cpt_category(spark, d):
    """Category of every procedure code occurrence, 'other' if unknown."""
    return PR.categorize(PR.exploded_codes(claims(spark, d))).select("claim_id", "pos", "cpt_code", "category")


@register("cpt_high_cost", _EXPLODE_SQL +
          f"SELECT claim_id, pos, cpt_code, cpt_code IN {S.sql_in(codes.HIGH_COST_PROCEDURES)} AS is_high_cost FROM ex")
def q_cpt_high_cost(spark, d):
    """P5: high-cost test per code occurrence."""
    ex = PR.exploded_codes(claims(spark, d))
    return ex.select("claim_id", "pos", "cpt_code",
                     F.col("cpt_code").isin(*codes.HIGH_COST_PROCEDURES).alias("is_high_cost"))


@register("join_cpt_category", _EXPLODE_SQL +
          "SELECT ex.claim_id, ex.pos, ex.cpt_code, coalesce(dim.category, 'other') AS category, "
          "coalesce(dim.is_high_cost, false) AS is_high_cost FROM ex LEFT JOIN dim ON ex.cpt_code = dim.cpt_code")
def q_join_cpt(spark, d):
    """Broadcast left join of exploded codes to the CPT dimension."""
    return PR.categorize(PR.exploded_codes(claims(spark, d))).select(
        "claim_id", "pos", "cpt_code", "category", "is_high_cost")


@register("agg_procedure_complexity", _EXPLODE_SQL +
          "SELECT ex.claim_id, coalesce(dim.category, 'other') AS category, COUNT(*) AS n_codes "
          "FROM ex LEFT JOIN dim ON ex.cpt_code = dim.cpt_code GROUP BY ALL")
def q_complexity(spark, d):
    """Procedure counts per category per claim."""
    return PR.procedure_complexity(claims(spark, d))


@register("agg_category_flags", S.with_() +
          "SELECT claim_id, has_surgery, has_radiology, has_pathology, has_eval_mgmt FROM feat")
def q_flags(spark, d):
    """Category flags from each claim's own codes."""
    return PR.category_flags(claims(spark, d))


@register("semi_high_cost_claims", "WITH " + S.claims_cte() + f"""
SELECT claim_id FROM claims
WHERE list_has_any(CASE WHEN procedure_codes IS NULL OR regexp_matches(procedure_codes, {S.BLANK})
      THEN []::VARCHAR[] ELSE string_split(procedure_codes, '|') END, {S.sql_list(codes.HIGH_COST_PROCEDURES)})""")
def q_semi_hc(spark, d):
    """Claims with a high-cost code."""
    return PR.high_cost_claims(claims(spark, d)).select("claim_id")


_POS_VALUES = ", ".join(f"({S.q(k)}, {S.q(v)})" for k, v in codes.POS_SHORT_LABELS.items())


@register("join_pos_label", "WITH " + S.claims_cte() + f""",
dim AS (SELECT * FROM (VALUES {_POS_VALUES}) t(place_of_service, pos_label))
SELECT c.claim_id, coalesce(dim.pos_label, 'Other') AS pos_label
FROM claims c LEFT JOIN dim ON c.place_of_service = dim.place_of_service""")
def q_join_pos(spark, d):
    """POS label lookup, unmatched → Other."""
    return PR.pos_labels(claims(spark, d)).select("claim_id", "pos_label")


@register("claim_status", "WITH " + S.claims_cte() +
          "\nSELECT claim_id, CASE WHEN is_denied = 1 THEN 'DENIED' ELSE 'APPROVED' END AS status FROM claims")
def q_status(spark, d):
    """Actual status label."""
    return claims(spark, d).select(
        "claim_id", F.when(F.col("is_denied") == 1, "DENIED").otherwise("APPROVED").alias("status"))


# --------------------------------------------------------------------------
# Scoring R1–R9, A15, J7
# --------------------------------------------------------------------------
def scored(spark, d, policy="batch"):
    hist = "loo" if policy == "batch" else "default"
    return SC.RuleScorer().score(wide(spark, d, hist, policy))


@register("score_rules", S.with_(scored=True) + "SELECT claim_id, p_denial AS denial_probability FROM sc")
def q_score_rules(spark, d):
    """Rule-scorecard probability."""
    return scored(spark, d).select("claim_id", F.col(SC.P).alias("denial_probability"))


@register("predict_batch", S.with_(scored=True) + f"""SELECT claim_id,
  {S.np_round_sql("p_denial", 4)} AS denial_probability, p_denial >= 0.5 AS predicted_denied,
  {S.CONF_BATCH} AS confidence, {S.REIMB_BATCH} AS estimated_reimbursement FROM sc""")
def q_predict_batch(spark, d):
    """R2: batch prediction frame."""
    return SC.predict_batch(wide(spark, d))


@register("confidence_batch", S.with_(scored=True) + f"SELECT claim_id, {S.CONF_BATCH} AS confidence FROM sc")
def q_conf_batch(spark, d):
    """Batch confidence bands."""
    return scored(spark, d).select("claim_id", R.confidence_batch(F.col(SC.P)).alias("confidence"))


@register("confidence_serve", S.with_(scored=True) + f"SELECT claim_id, {S.CONF_SERVE} AS confidence FROM sc")
def q_conf_serve(spark, d):
    """Serve confidence labels."""
    return scored(spark, d).select("claim_id", R.confidence_serve(F.col(SC.P)).alias("confidence"))


@register("reimbursement_batch", S.with_(scored=True) +
          f"SELECT claim_id, {S.REIMB_BATCH} AS estimated_reimbursement FROM sc")
def q_reimb_batch(spark, d):
    """Expected reimbursement (unrounded)."""
    return scored(spark, d).select(
        "claim_id", R.reimbursement_batch(R.predicted_denied(F.col(SC.P))).alias("estimated_reimbursement"))


_REIMB_SERVE = S.np_round_sql("CASE WHEN p_denial >= 0.5 THEN 0.0 WHEN allowed_amount > 0 THEN allowed_amount "
                               "ELSE billed_amount * 0.65 END", 2)


@register("reimbursement_serve", S.with_(scored=True) +
          f"SELECT claim_id, {_REIMB_SERVE} AS estimated_reimbursement FROM sc")
def q_reimb_serve(spark, d):
    """Expected reimbursement rounded to cents."""
    return scored(spark, d).select(
        "claim_id", R.reimbursement_serve(R.predicted_denied(F.col(SC.P))).alias("estimated_reimbursement"))


@register("denial_reasons", S.with_(scored=True) +
          f"SELECT claim_id, array_to_string({S.REASONS}, '|') AS denial_reasons FROM sc")
def q_reasons(spark, d):
    """Ordered denial reasons (batch-policy features)."""
    return scored(spark, d).select("claim_id", R.denial_reasons(F.col(SC.P)).alias("denial_reasons"))


_PREDICT_SERVE_SQL = (S.with_(policy="serve", scored=True) + f"""SELECT coalesce(claim_id, 'unknown') AS claim_id,
  {S.np_round_sql("p_denial", 4)} AS denial_probability, p_denial >= 0.5 AS predicted_denied,
  array_to_string({S.REASONS}, '|') AS denial_reasons, {_REIMB_SERVE} AS estimated_reimbursement,
  {S.CONF_SERVE} AS confidence, '1.2.0' AS model_version FROM sc""")


@register("predict_claims", _PREDICT_SERVE_SQL)
def q_predict_claims(spark, d):
    """Full serve-form record for every claim."""
    return SC.predict_claims(wide(spark, d, "default", "serve"))


def _batch_id():
    return F.date_format("service_date", "yyyy-MM")


@register("predict_batch_endpoint", S.with_(policy="serve", scored=True) + """SELECT
  strftime(service_date, '%Y-%m') AS batch_id, COUNT(*) AS total_claims,
  CAST(SUM(CASE WHEN p_denial >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS total_predicted_denied,
  coalesce(CAST(SUM(CASE WHEN p_denial >= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(COUNT(*), 0), 0.0)
    AS batch_denial_rate
FROM sc GROUP BY 1""")
def q_predict_batch_endpoint(spark, d):
    """Serve-form records per monthly batch + batch summary."""
    f = wide(spark, d, "default", "serve").withColumn("batch_id", _batch_id())
    _, summary = SC.predict_batch_endpoint(f, "batch_id")
    return summary


@register("predict_batch_records", _PREDICT_SERVE_SQL.replace("SELECT coalesce(claim_id", "SELECT strftime(service_date, '%Y-%m') AS batch_id, coalesce(claim_id", 1))
def q_predict_batch_records(spark, d):
    """The endpoint's records, each with its monthly batch."""
    f = wide(spark, d, "default", "serve").withColumn("batch_id", _batch_id())
    return SC.predict_batch_endpoint(f, "batch_id")[0]


@register("batch_summary", S.with_(scored=True) + """SELECT COUNT(*) AS total_claims,
  CAST(coalesce(SUM(CASE WHEN p_denial >= 0.5 THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_predicted_denied,
  coalesce(CAST(SUM(CASE WHEN p_denial >= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(COUNT(*), 0), 0.0)
    AS batch_denial_rate FROM sc""")
def q_batch_summary(spark, d):
    """Total, predicted denied, rate over the whole scored table."""
    return SC.batch_summary(SC.predict_batch(wide(spark, d)))


@register("join_predictions_claims", S.with_(scored=True) + f"""SELECT c.claim_id, c.claim_type, c.is_denied,
  {S.np_round_sql("s.p_denial", 4)} AS denial_probability, s.p_denial >= 0.5 AS predicted_denied
FROM claims c JOIN sc s ON c.claim_id = s.claim_id""")
def q_join_predictions(spark, d):
    """Predictions joined back to claims by claim_id (not by position)."""
    c = claims(spark, d)
    p = SC.predict_batch(FE.features_wide(c)).select("claim_id", "denial_probability", "predicted_denied")
    return c.select("claim_id", "claim_type", "is_denied").join(p, on="claim_id", how="inner")
