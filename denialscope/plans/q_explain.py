"""Registered queries: explanations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import explain as X
from ..operators import features as FE
from ..session import scratch_path
from ..sources import files
from ..sources.fixtures import claims
from ..sources.schema import FEATURE_COLUMNS
from . import sqlparts as S
from .registry import register

D = S.D
TERMS = list(S.rule_terms_sql().keys())

# Linear part of the rule scorecard, used as a fixed-coefficient linear model
# for the SQL-checkable form of the linear explainer.
LINEAR_COEFFS = {"provider_historical_denial_rate": 0.3, "has_chronic_condition": 0.05,
                 "is_emergency": -0.1, "is_pharmacy_claim": 0.03, "has_surgery": 0.1,
                 "late_submission": 0.35}
LINEAR_INTERCEPT = 0.1


#: Raw columns that the rules read beside the features.
_RAW = ("billed_amount", "claim_type", "place_of_service")


def _rules_expl(spark, d, policy="batch", values=False):
    hist = "loo" if policy == "batch" else "default"
    f = FE.features_wide(claims(spark, d), provider_history=hist, policy=policy)
    # the means and the rows both read the features: they are made once
    f = files.materialize(f.select("claim_id", *_RAW, *FEATURE_COLUMNS), scratch_path(spark, f"explained/{uuid.uuid4().hex}"))
    return X.explain_rules(f, values=values)


# -------------------------------------------------------------- oracle CTEs
def _ex_ctes(src="feat"):
    terms = S.rule_terms_sql()
    te = ("te AS (SELECT claim_id, " + ", ".join(f"{e} AS t_{t}" for t, e in terms.items())
          + f" FROM {src})")
    mn = "mn AS (SELECT " + ", ".join(f"AVG(t_{t}) AS m_{t}" for t in terms) + " FROM te)"
    raw = " + ".join(f"(t_{t})" for t in terms)
    contrib = []
    for f in FEATURE_COLUMNS:
        term = next((t for t, ff in X.RULE_TERM_FEATURE.items() if ff == f), None)
        contrib.append(f"(t_{term} - m_{term}) AS c_{f}" if term else f"{D(0.0)} AS c_{f}")
    base = " + ".join([D(0.0)] + [f"m_{t}" for t in terms])
    ex = (f"ex AS (SELECT claim_id, {base} AS base_value, least(greatest({raw}, {D(0.02)}), {D(0.95)}) AS prediction, "
          f"{raw} AS raw_score, least(greatest({raw}, {D(0.02)}), {D(0.95)}) - ({raw}) AS clip_residual, "
          + ", ".join(contrib) + " FROM te, mn)")
    return [te, mn, ex]


def _rnd(c):
    return S.np_round_sql(c, 6)


def _entries_sql():
    return "[" + ", ".join(
        f"{{'k': -abs({_rnd('c_' + f)}), 'i': {i}, 'f': {S.q(f)}, 'v': {_rnd('c_' + f)}}}"
        for i, f in enumerate(FEATURE_COLUMNS)) + "]"


def _waterfall_entries_sql():
    return "[" + ", ".join(
        f"{{'k': -abs({_rnd('c_' + f)}), 'i': {-i}, 'f': {S.q(f)}, 'v': {_rnd('c_' + f)}}}"
        for i, f in enumerate(FEATURE_COLUMNS)) + "]"


def _factors_sql():
    srt = f"list_sort({_entries_sql()})"
    risk = f"list_transform(list_filter({srt}, lambda e: e.v > 0.01)[1:5], lambda e: e.f)"
    prot = f"list_transform(list_filter({srt}, lambda e: e.v < -0.01)[1:5], lambda e: e.f)"
    return (f"array_to_string({risk}, '|') AS top_risk_factors, "
            f"array_to_string({prot}, '|') AS top_protective_factors")


_EX_SQL = S.with_(*_ex_ctes(), scored=False)
_EX_SERVE_SQL = S.with_(*_ex_ctes(), policy="serve")


@register("explain_rules", _EX_SQL + "SELECT * FROM ex")
def q_explain_rules(spark, d):
    """Additive rule contributions against dataset term means."""
    return _rules_expl(spark, d)


@register("explain_batch", _EX_SQL + f"""SELECT claim_id, {_rnd('base_value')} AS base_value,
  {S.np_round_sql('prediction', 4)} AS prediction, {_factors_sql()} FROM ex""")
def q_explain_batch(spark, d):
    """Explanation records (their maps: explain_batch_map)."""
    return X.explanation_records(_rules_expl(spark, d)).drop("feature_contributions")


@register("explain_claims", _EX_SERVE_SQL + f"""SELECT claim_id, {_rnd('base_value')} AS base_value,
  {S.np_round_sql('prediction', 4)} AS prediction, {_factors_sql()} FROM ex""")
def q_explain_claims(spark, d):
    """E5: serve-form explanation records (their maps: explain_claims_map)."""
    return X.explanation_records(_rules_expl(spark, d, "serve")).drop("feature_contributions")


def _long(names, values, value):
    return f"unnest({S.sql_list(names)}) AS feature, unnest([{', '.join(values)}]) AS {value}"


@register("explain_batch_map", _EX_SQL + f"SELECT claim_id, {_long(FEATURE_COLUMNS, [_rnd('c_' + f) + ' + 0.0' for f in FEATURE_COLUMNS], 'contribution')} FROM ex")
def q_explain_batch_map(spark, d):
    """The contribution map of every record, one row a feature."""
    r = X.explanation_records(_rules_expl(spark, d))
    return r.select("claim_id", F.explode("feature_contributions").alias("feature", "contribution")).withColumn("contribution", F.col("contribution") + 0.0)


_VALUES = [f"CAST({f} AS DOUBLE)" for f in FEATURE_COLUMNS]


@register("explain_claims_map", S.with_(*_ex_ctes(), policy="serve") + f"""SELECT f.claim_id, f.feature, f.value, e.contribution FROM
  (SELECT claim_id, {_long(FEATURE_COLUMNS, _VALUES, 'value')} FROM feat) f JOIN
  (SELECT claim_id, {_long(FEATURE_COLUMNS, [_rnd('c_' + f) + ' + 0.0' for f in FEATURE_COLUMNS], 'contribution')} FROM ex) e
  ON f.claim_id = e.claim_id AND f.feature = e.feature""")
def q_explain_claims_map(spark, d):
    """E5: feature values and contributions of every record, one row a feature."""
    r = X.explanation_records(_rules_expl(spark, d, "serve", values=True))
    # both maps hold the features in one order, so they are zipped, not searched
    rows = F.zip_with(F.map_entries("feature_values"), F.map_values("feature_contributions"), lambda e, c: F.struct(
        e["key"].alias("feature"), e["value"].alias("value"), (c + 0.0).alias("contribution")))
    return r.select("claim_id", F.inline(rows))


@register("top_factors", _EX_SQL + f"SELECT claim_id, {_factors_sql()} FROM ex")
def q_top_factors(spark, d):
    """Top risk / protective factor lists."""
    e = _rules_expl(spark, d)
    risk, prot = X.top_factors(e)
    return e.select("claim_id", risk.alias("top_risk_factors"), prot.alias("top_protective_factors"))


_GI = ("gi AS (SELECT * FROM (SELECT " + ", ".join(f"AVG(abs(c_{f})) AS c_{f}" for f in FEATURE_COLUMNS)
       + " FROM ex) UNPIVOT (importance FOR feature IN (" + ", ".join(f"c_{f}" for f in FEATURE_COLUMNS) + ")))")
_GI_SEL = (f"SELECT CAST(list_position({S.sql_list(['c_' + f for f in FEATURE_COLUMNS])}, feature) - 1 AS INT) "
           f"AS feature_index, substr(feature, 3) AS feature, {_rnd('importance')} AS importance FROM gi")


@register("global_importance", S.with_(*_ex_ctes(), _GI) + _GI_SEL)
def q_global_importance(spark, d):
    """Mean absolute contribution per feature."""
    return X.global_importance(_rules_expl(spark, d))


_TOP15 = f"SELECT * FROM ({_GI_SEL}) ORDER BY importance DESC, feature_index LIMIT 15"


@register("global_importance_top", S.with_(*_ex_ctes(), _GI) + _TOP15)
def q_global_importance_top(spark, d):
    """15 most important features by mean |contribution|."""
    return X.top_global_importance(_rules_expl(spark, d))


@register("top_global_importance", S.with_(*_ex_ctes(), _GI) + _TOP15)
def q_top_global_importance(spark, d):
    """T4: sorted importance, first 15 (ties in feature order)."""
    return X.top_global_importance(_rules_expl(spark, d), k=15)


@register("waterfall_top12", _EX_SQL + f"""SELECT claim_id, CAST(r AS INT) AS rank, e.f AS feature, e.v AS contribution
FROM (SELECT claim_id, unnest(t) AS e, generate_subscripts(t, 1) AS r
      FROM (SELECT claim_id, list_sort({_waterfall_entries_sql()})[1:12] AS t FROM ex))""")
def q_waterfall(spark, d):
    """12 largest absolute contributions per claim."""
    return X.waterfall_top(_rules_expl(spark, d))


def _lin_sql():
    xs = {f: f"CAST(coalesce({f}, 0) AS DOUBLE)" for f in FEATURE_COLUMNS}
    mean = "lm AS (SELECT " + ", ".join(f"AVG({xs[f]}) AS m_{f}" for f in FEATURE_COLUMNS) + " FROM feat)"
    beta = {f: float(LINEAR_COEFFS.get(f, 0.0)) for f in FEATURE_COLUMNS}
    base = " + ".join([D(0.0)] + [f"{D(beta[f])} * m_{f}" for f in FEATURE_COLUMNS]) + f" + {D(LINEAR_INTERCEPT)}"
    contrib = {f: f"({xs[f]} - m_{f}) * {D(beta[f])}" for f in FEATURE_COLUMNS}
    margin = " + ".join([f"({base})"] + [contrib[f] for f in FEATURE_COLUMNS])
    return S.with_(mean) + (f"SELECT claim_id, {base} AS base_value, {margin} AS prediction, "
                            + ", ".join(f"{contrib[f]} AS c_{f}" for f in FEATURE_COLUMNS) + " FROM feat, lm")


@register("explain_linear", _lin_sql())
def q_explain_linear(spark, d):
    """Linear-model contributions (fixed coefficients: the scorecard's linear part)."""
    f = FE.features_wide(claims(spark, d))
    return X.explain_linear(f, LINEAR_COEFFS, LINEAR_INTERCEPT)
