"""Additive explanations as Spark jobs.

* ``explain_rules`` (E2) — exact additive contributions of the rule
  scorecard: each term minus its dataset mean (the interventional SHAP value
  of an additive model); the clip to [0.02, 0.95] is a separate residual.
* ``explain_linear`` (E1) — βᵢ(xᵢ − x̄ᵢ) for a linear model, base β·x̄ + b.

Dataset means are one aggregate (23 values) attached as literals, so a
contribution is a plain projection; records (E4/E5), factor lists (T3),
global importance (A19/E6/T4) and the waterfall (T8) are native array /
aggregate expressions on top.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..sources.schema import FEATURE_COLUMNS

# Rule-scorecard terms and the model feature each one explains.
RULE_TERM_FEATURE = {
    "lag": "submission_lag_days",
    "billed": "log_billed_amount",
    "provider": "provider_historical_denial_rate",
    "chronic": "has_chronic_condition",
    "emergency": "is_emergency",
    "pharmacy": "is_pharmacy_claim",
    "inpatient": "is_inpatient",
    "surgery": "has_surgery",
}
# FIXED VALUES — factor thresholds and list sizes of the explanation record.
FACTOR_THRESHOLD = 0.01
MAX_FACTORS = 5
MAX_GLOBAL = 15
WATERFALL_K = 12

C = "c_"  # contribution column prefix


def _contrib_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(C)]


def explain_rules(features: DataFrame, background: DataFrame | None = None, values: bool = False) -> DataFrame:
    """claim_id, base_value, prediction, raw_score, clip_residual and one
    ``c_<feature>`` contribution column per model feature.

    ``background`` (default: ``features`` itself) supplies the term means.
    ``values`` adds the map ``feature_values`` (E5).
    """
    terms = R.rule_terms()
    bg = background if background is not None else features
    if "submission_lag_days" not in bg.columns:
        from .features import features_wide
        bg = features_wide(bg)
    means = bg.agg(*[F.avg(e).alias(t) for t, e in terms.items()]).first().asDict()
    base = sum(means[t] for t in terms)
    raw = R.rule_raw_score()
    contrib = {f: F.lit(0.0) for f in FEATURE_COLUMNS}
    for t, f in RULE_TERM_FEATURE.items():
        contrib[f] = terms[t] - F.lit(means[t])
    pred = R.clip_probability(raw)
    return features.select(
        "claim_id",
        F.lit(base).alias("base_value"),
        pred.alias("prediction"),
        raw.alias("raw_score"),
        (pred - raw).alias("clip_residual"),
        *[contrib[f].alias(C + f) for f in FEATURE_COLUMNS],
        *([feature_values().alias("feature_values")] if values else []))


def feature_values():
    """Map of the model features' values."""
    return F.map_from_arrays(F.array(*[F.lit(f) for f in FEATURE_COLUMNS]), F.array(*[F.col(f).cast("double") for f in FEATURE_COLUMNS]))


def explain_linear(features: DataFrame, coefficients: dict[str, float], intercept: float,
                   background: DataFrame | None = None) -> DataFrame:
    """βᵢ(xᵢ − x̄ᵢ) on model-input values (null → 0), base β·x̄ + b,
    prediction = base + Σ contributions (the model margin)."""
    bg = background if background is not None else features
    x = {f: F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.lit(0.0)) for f in FEATURE_COLUMNS}
    means = bg.agg(*[F.avg(x[f]).alias(f) for f in FEATURE_COLUMNS]).first().asDict()
    beta = {f: float(coefficients.get(f, 0.0)) for f in FEATURE_COLUMNS}
    base = sum(beta[f] * (means[f] or 0.0) for f in FEATURE_COLUMNS) + intercept
    contrib = {f: (x[f] - F.lit(means[f] or 0.0)) * F.lit(beta[f]) for f in FEATURE_COLUMNS}
    margin = F.lit(base)
    for f in FEATURE_COLUMNS:
        margin = margin + contrib[f]
    return features.select("claim_id", F.lit(base).alias("base_value"), margin.alias("prediction"),
                           *[contrib[f].alias(C + f) for f in FEATURE_COLUMNS])


def _entries(df: DataFrame, decimals: int = 6):
    """array<struct<idx, feature, value>> of rounded contributions, feature order."""
    cols = _contrib_cols(df)
    return F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(c[len(C):]).alias("feature"),
                              R.np_round(F.col(c), decimals).alias("value"))
                     for i, c in enumerate(cols)])


def top_factors(df: DataFrame, k: int = MAX_FACTORS, threshold: float = FACTOR_THRESHOLD):
    """(risk, protective) name lists: ≤ k contributions above +threshold /
    below −threshold, by |contribution| descending, ties in feature order."""
    return _factor_lists(_ordered(_entries(df)), k, threshold)


def _ordered(ent):
    """Entries sorted by |value| descending, ties in feature order."""
    return F.array_sort(F.transform(ent, lambda e: F.struct(-F.abs(e["value"]), e["idx"], e["feature"], e["value"])))


def _factor_lists(ordered, k: int = MAX_FACTORS, threshold: float = FACTOR_THRESHOLD):
    risk = F.transform(F.slice(F.filter(ordered, lambda e: e["value"] > threshold), 1, k), lambda e: e["feature"])
    prot = F.transform(F.slice(F.filter(ordered, lambda e: e["value"] < -threshold), 1, k), lambda e: e["feature"])
    return risk, prot


def explanation_records(expl: DataFrame) -> DataFrame:
    """Base (6 dp), prediction (4 dp), contribution map (6 dp), factor
    lists; E5 where ``expl`` carries ``feature_values``.

    The rounded entries and their sort are materialised once per row (a
    projection below the one that reads them twice)."""
    more = [c for c in ("feature_values",) if c in expl.columns]
    staged = expl.select("claim_id", "base_value", "prediction", *more, _entries(expl).alias("__ent"))
    staged = staged.withColumn("__ord", _ordered(F.col("__ent")))
    risk, prot = _factor_lists(F.col("__ord"))
    ent = F.col("__ent")
    return staged.select(
        "claim_id",
        R.np_round(F.col("base_value"), 6).alias("base_value"),
        R.np_round(F.col("prediction"), 4).alias("prediction"),
        F.map_from_arrays(F.transform(ent, lambda e: e["feature"]),
                          F.transform(ent, lambda e: e["value"])).alias("feature_contributions"),
        risk.alias("top_risk_factors"),
        prot.alias("top_protective_factors"), *more)


def global_importance(expl: DataFrame) -> DataFrame:
    """Mean |contribution| per feature (6 dp), one pass, long output."""
    cols = _contrib_cols(expl)
    row = expl.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in cols])
    stacked = F.array(*[F.struct(F.lit(i).alias("feature_index"), F.lit(c[len(C):]).alias("feature"),
                                 R.np_round(F.col(c), 6).alias("importance")) for i, c in enumerate(cols)])
    return row.select(F.inline(stacked))


def top_global_importance(expl: DataFrame, k: int = MAX_GLOBAL) -> DataFrame:
    """The k most important features (ties in feature order)."""
    return global_importance(expl).orderBy(F.desc("importance"), "feature_index").limit(k)


def waterfall_top(expl: DataFrame, k: int = WATERFALL_K) -> DataFrame:
    """Per claim, the k largest |contributions| as (rank, feature, value);
    ties: higher feature index first (reversed stable argsort)."""
    ent = _entries(expl)
    keyed = F.transform(ent, lambda e: F.struct(-F.abs(e["value"]), -e["idx"], e["feature"], e["value"]))
    top = F.slice(F.array_sort(keyed), 1, k)
    return expl.select("claim_id", F.posexplode(top).alias("rank", "e")).select(
        "claim_id", (F.col("rank") + 1).alias("rank"), F.col("e")["feature"].alias("feature"),
        F.col("e")["value"].alias("contribution"))
