"""Registered queries: KPI aggregates, top-k, flagship."""

from __future__ import annotations

from ..operators import kpis as K
from ..sources import codes
from ..sources.fixtures import claims
from . import sqlparts as S
from .dashboard import predicted_vs_actual_by_type, sample_claim_ids
from .registry import register

_C = "WITH " + S.claims_cte() + "\n"


@register("kpi_summary_base", _C + "SELECT COUNT(*) AS n_claims, AVG(CAST(is_denied AS DOUBLE)) AS denial_rate "
          "FROM claims")
def q_summary(spark, d):
    """A3: size and denial rate."""
    return K.summary_base(claims(spark, d))


@register("kpi_overview", _C + "SELECT COUNT(*) AS total_claims, AVG(CAST(is_denied AS DOUBLE)) AS denial_rate, "
          "AVG(billed_amount) AS avg_billed FROM claims")
def q_overview(spark, d):
    """A4: KPI row."""
    return K.overview(claims(spark, d))


@register("kpi_by_claim_type", _C + "SELECT claim_type, AVG(CAST(is_denied AS DOUBLE)) AS denial_rate, "
          "COUNT(is_denied) AS n_claims FROM claims WHERE claim_type IS NOT NULL GROUP BY claim_type")
def q_by_type(spark, d):
    """A5: denial rate by claim type."""
    return K.by_claim_type(claims(spark, d))


@register("kpi_monthly", _C + """SELECT strftime(service_date, '%Y-%m') AS service_month, COUNT(claim_id) AS total,
  CAST(SUM(is_denied) AS BIGINT) AS denied, COUNT(claim_id) - CAST(SUM(is_denied) AS BIGINT) AS approved
FROM claims WHERE service_date IS NOT NULL GROUP BY 1""")
def q_monthly(spark, d):
    """Monthly volume."""
    return K.monthly(claims(spark, d))


_SPEC = ("SELECT provider_specialty, AVG(CAST(is_denied AS DOUBLE)) AS denial_rate, COUNT(is_denied) AS n_claims "
         "FROM claims WHERE provider_specialty IS NOT NULL GROUP BY provider_specialty")


@register("kpi_by_specialty", _C + _SPEC)
def q_by_specialty(spark, d):
    """Denial rate by specialty."""
    return K.by_specialty(claims(spark, d))


@register("top_specialties", _C + f"SELECT * FROM ({_SPEC}) ORDER BY denial_rate DESC, provider_specialty LIMIT 10")
def q_top_specialties(spark, d):
    """Ten highest-denial specialties."""
    return K.top_specialties(claims(spark, d))


@register("kpi_pos_breakdown", _C + """, dim AS (SELECT * FROM (VALUES """ +
          ", ".join(f"({S.q(k)}, {S.q(v)})" for k, v in codes.POS_SHORT_LABELS.items()) +
          """) t(place_of_service, pos_label))
SELECT coalesce(dim.pos_label, 'Other') AS pos_label, COUNT(*) AS n_claims
FROM claims c LEFT JOIN dim ON c.place_of_service = dim.place_of_service GROUP BY 1""")
def q_pos(spark, d):
    """Counts by POS label."""
    return K.pos_breakdown(claims(spark, d))


@register("kpi_billed_histogram", _C + """, mm AS (SELECT min(billed_amount) AS lo, max(billed_amount) AS hi FROM claims),
hw AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0 END AS width FROM mm),
hb AS (SELECT CAST(least(floor((billed_amount - hw.lo) / hw.width), 49) AS INT) AS bin, is_denied, hw.lo, hw.width
      FROM claims, hw WHERE billed_amount IS NOT NULL)
SELECT bin, is_denied, any_value(lo) + bin * any_value(width) AS bin_start,
       any_value(lo) + (bin + 1) * any_value(width) AS bin_end, COUNT(*) AS n_claims
FROM hb GROUP BY bin, is_denied""")
def q_hist(spark, d):
    """50-bin billed histogram by outcome."""
    return K.billed_histogram(claims(spark, d))


@register("kpi_billed_p95", _C + "SELECT quantile_cont(billed_amount, 0.95) AS billed_p95 FROM claims")
def q_p95(spark, d):
    """A10: exact 95th percentile of billed."""
    return K.billed_p95(claims(spark, d))


@register("gen_profile", _C + """SELECT claim_type, COUNT(*) AS n_claims,
  (SELECT AVG(billed_amount) FROM claims) AS billed_mean,
  (SELECT quantile_cont(billed_amount, 0.5) FROM claims) AS billed_median
FROM claims GROUP BY claim_type""")
def q_gen_profile(spark, d):
    """Type counts, billed mean and median."""
    return K.generator_profile(claims(spark, d))


@register("class_balance", _C + """SELECT CAST(SUM(CASE WHEN is_denied = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_negative,
  CAST(SUM(CASE WHEN is_denied = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive, COUNT(is_denied) AS n,
  CAST(SUM(CASE WHEN is_denied = 0 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(SUM(CASE WHEN is_denied = 1 THEN 1 ELSE 0 END), 0) AS pos_weight,
  CAST(SUM(CASE WHEN is_denied = 1 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(COUNT(is_denied), 0) AS pos_ratio
FROM claims""")
def q_class_balance(spark, d):
    """Class balance and positive weight."""
    return K.class_balance(claims(spark, d))


@register("sample_claim_ids", _C + "SELECT claim_id FROM claims ORDER BY claim_id LIMIT 5")
def q_sample_ids(spark, d):
    """T5: first five claim ids."""
    return sample_claim_ids(claims(spark, d))


@register("flagship_predicted_vs_actual", S.with_(scored=True) + """SELECT claim_type, COUNT(*) AS n_claims,
  AVG(CAST(is_denied AS DOUBLE)) AS actual_denial_rate,
  AVG(CASE WHEN p_denial >= 0.5 THEN 1.0 ELSE 0.0 END) AS predicted_denial_rate,
  AVG(p_denial) AS mean_probability FROM sc GROUP BY claim_type""")
def q_flagship(spark, d):
    """Flagship: predicted vs actual denial rate by claim type."""
    return predicted_vs_actual_by_type(claims(spark, d))

