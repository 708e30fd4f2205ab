"""Scoring-rule, confidence, reimbursement and denial-reason expressions.

All are native ``when`` chains / array builders evaluated inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schema import PREDICTION_THRESHOLD

# FIXED VALUES — denial reason texts, in rule order.
REASON_LATE = "Late submission (>90 days from date of service)"
REASON_DELAYED = "Submission significantly delayed"
REASON_PRIOR_AUTH = "High-cost procedure requires prior authorization"
REASON_UCR = "Billed amount exceeds usual and customary rates"
REASON_RATIO = "Billed amount significantly exceeds allowed amount"
REASON_PROVIDER = "Provider has elevated denial history — possible documentation issues"
REASON_INPATIENT = "Inpatient stay may require medical necessity review"
REASON_FALLBACK = "Multiple risk factors combined"

# FIXED VALUES — rule scorecard weights (denial probability components).
RULE_BASE = 0.10
RULE_LAG = [(90, 0.35), (60, 0.15), (30, 0.05)]
RULE_BILLED = [(10000, 0.15), (5000, 0.08)]
RULE_PROVIDER_WEIGHT = 0.3
RULE_CHRONIC = 0.05
RULE_EMERGENCY = -0.10
RULE_PHARMACY = 0.03
RULE_INPATIENT_21 = 0.08
RULE_SURGERY = 0.10
RULE_FLOOR, RULE_CAP = 0.02, 0.95


def _step(x: Column, steps: list[tuple[float, float]]) -> Column:
    """First matching ``x > threshold`` wins; else 0 (null x → 0)."""
    expr = None
    for thr, val in steps:
        expr = F.when(x > thr, F.lit(val)) if expr is None else expr.when(x > thr, F.lit(val))
    return expr.otherwise(F.lit(0.0))


def rule_terms(lag: Column | None = None, billed: Column | None = None,
               provider_rate: Column | None = None) -> dict[str, Column]:
    """The additive terms of the rule scorecard (pre-clip), by name.

    Inputs default to the feature frame's columns: filled submission lag,
    raw billed amount, provider history rate, chronic/surgery flags, POS and
    claim type. POS 21 only counts as inpatient here, as in the rule set.
    """
    lag = F.coalesce(F.col("submission_lag_days"), F.lit(0)) if lag is None else lag
    billed = F.col("billed_amount") if billed is None else billed
    rate = F.coalesce(F.col("provider_historical_denial_rate"), F.lit(0.0)) \
        if provider_rate is None else provider_rate
    pos = F.col("place_of_service")
    return {
        "base": F.lit(RULE_BASE),
        "lag": _step(lag, RULE_LAG),
        "billed": _step(billed, RULE_BILLED),
        "provider": rate * RULE_PROVIDER_WEIGHT,
        "chronic": F.when(F.col("has_chronic_condition") == 1, F.lit(RULE_CHRONIC)).otherwise(F.lit(0.0)),
        "emergency": F.when(pos == "23", F.lit(RULE_EMERGENCY)).otherwise(F.lit(0.0)),
        "pharmacy": F.when(F.col("claim_type") == "pharmacy", F.lit(RULE_PHARMACY)).otherwise(F.lit(0.0)),
        "inpatient": F.when(pos == "21", F.lit(RULE_INPATIENT_21)).otherwise(F.lit(0.0)),
        "surgery": F.when(F.col("has_surgery") == 1, F.lit(RULE_SURGERY)).otherwise(F.lit(0.0)),
    }


def rule_raw_score(**kw) -> Column:
    terms = list(rule_terms(**kw).values())
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def clip_probability(raw: Column) -> Column:
    return F.least(F.greatest(raw, F.lit(RULE_FLOOR)), F.lit(RULE_CAP))


def rule_probability(**kw) -> Column:
    """Clipped rule-scorecard denial probability."""
    return clip_probability(rule_raw_score(**kw))


def np_round(x: Column, decimals: int) -> Column:
    """NumPy-style rounding: ``rint(x·10ⁿ)/10ⁿ`` (half-even on the scaled binary value)."""
    f = float(10 ** decimals)
    return F.rint(x * f) / f


def exact_avg(x: Column, decimals: int = 9) -> Column:
    """Order-independent mean: values fixed to ``decimals`` places, summed as
    an exact DECIMAL(38, 0), then divided. Floating sums depend on partition
    order; this does not, so small windows of round-valued probabilities give
    the same bits on every cluster layout."""
    f = float(10 ** decimals)
    s = F.sum(F.rint(x * f).cast("decimal(38,0)")).cast("double")
    return s / F.count(x).cast("double") / f


def predicted_denied(p: Column, threshold: float = PREDICTION_THRESHOLD) -> Column:
    return p >= F.lit(threshold)


def confidence_batch(p: Column) -> Column:
    """Right-closed bands over (0, 1]; p = 0 (or outside) → null."""
    return (F.when((p > 0) & (p <= 0.2), "high_approve")
            .when((p > 0.2) & (p <= 0.4), "medium")
            .when((p > 0.4) & (p <= 0.6), "low")
            .when((p > 0.6) & (p <= 0.8), "medium")
            .when((p > 0.8) & (p <= 1.0), "high_deny"))


def confidence_serve(p: Column) -> Column:
    """> .8 high; > .6 or < .2 medium; else low."""
    return F.when(p > 0.8, "high").when((p > 0.6) | (p < 0.2), "medium").otherwise("low")


def reimbursement_batch(denied: Column, allowed: Column | None = None,
                        billed: Column | None = None) -> Column:
    """Denied → 0; allowed > 0 → allowed; else 65 % of billed (unrounded)."""
    allowed = F.col("allowed_amount") if allowed is None else allowed
    billed = F.col("billed_amount") if billed is None else billed
    allowed = F.nanvl(allowed, F.lit(None).cast("double"))
    return (F.when(denied, F.lit(0.0))
            .when(allowed > 0, allowed)
            .otherwise(billed * 0.65))


def reimbursement_serve(denied: Column, allowed: Column | None = None,
                        billed: Column | None = None) -> Column:
    """As R5 but rounded half-even to cents."""
    return np_round(reimbursement_batch(denied, allowed, billed), 2)


def denial_reasons(p: Column) -> Column:
    """Ordered reason list from a feature row and its probability."""
    g = F.col
    rules = [
        (g("late_submission") == 1, REASON_LATE),
        (g("submission_lag_days") > 60, REASON_DELAYED),
        ((g("has_high_cost_procedure") == 1) & (p > 0.5), REASON_PRIOR_AUTH),
        (g("log_billed_amount") > F.log1p(F.lit(10000.0)), REASON_UCR),
        (g("billed_to_allowed_ratio") > 3.0, REASON_RATIO),
        (g("provider_historical_denial_rate") > 0.4, REASON_PROVIDER),
        ((g("is_inpatient") == 1) & (p > 0.5), REASON_INPATIENT),
    ]
    found = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(t)) for c, t in rules]),
                     lambda x: x.isNotNull())
    return F.when((F.size(found) == 0) & (p > 0.5), F.array(F.lit(REASON_FALLBACK))).otherwise(found)
