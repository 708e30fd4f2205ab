"""Dashboard data jobs (overview page, claim detail) and the flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import kpis
from ..operators.features import features_wide
from ..operators.scoring import RuleScorer
from ..session import cut_lineage


def predicted_vs_actual_by_type(claims: DataFrame, scorer=None) -> DataFrame:
    """Flagship: claims → 23 features (leave-one-out provider history) →
    scorer → actual vs predicted denial rate per claim type."""
    scored = (scorer or RuleScorer()).score(features_wide(claims))
    return kpis.predicted_vs_actual_by_type(scored)


def overview_tables(claims: DataFrame) -> dict[str, DataFrame]:
    """Q3: every overview aggregate from one written copy of the seven columns
    that the page uses."""
    base = cut_lineage(claims.select("claim_id", "claim_type", "place_of_service", "billed_amount",
                         "service_date", "provider_specialty", "is_denied"))
    return {
        "overview": kpis.overview(base),
        "by_claim_type": kpis.by_claim_type(base),
        "monthly": kpis.monthly(base),
        "billed_histogram": kpis.billed_histogram(base),
        "billed_p95": kpis.billed_p95(base),
        "top_specialties": kpis.top_specialties(base),
        "pos_breakdown": kpis.pos_breakdown(base),
    }


def sample_claim_ids(claims: DataFrame, k: int = 5) -> DataFrame:
    """T5: first k claim ids in id order (explicit order; top-k is the feature)."""
    return claims.select("claim_id").orderBy("claim_id").limit(k)


PARTS = ("claim", "features", "prediction", "waterfall")


def claim_detail(claims: DataFrame, claim_id: str, scorer=None, parts: tuple[str, ...] = PARTS) -> dict[str, DataFrame]:
    """Q4: claim row, its serve-form features, prediction and top-12
    contributions (rule explanation); only the ``parts`` asked for are built.
    The filter is pushed into the scan; provider history comes from the
    labelled claims of the claim's own provider. The waterfall's term means
    take a pass over all claims."""
    from ..functions.features import feature_exprs
    from ..operators import explain as X
    from ..operators.history import NPI, RATE, with_history_rate
    from ..operators.scoring import predict_claims

    row = claims.where(F.col("claim_id") == claim_id)
    out = {"claim": row}
    if set(parts) - {"claim"}:
        own = claims.select(NPI, "is_denied").join(row.select(NPI).distinct(), NPI, "left_semi")
        with_rate = with_history_rate(row, own)
        exprs = feature_exprs("serve", provider_rate=F.col(RATE))
        raw = [c for c in with_rate.columns if c != RATE and c not in exprs]
        out["features"] = with_rate.select(*raw, *[e.alias(n) for n, e in exprs.items()])
    if "prediction" in parts:
        out["prediction"] = predict_claims(out["features"], scorer)
    if "waterfall" in parts:
        out["waterfall"] = X.waterfall_top(X.explain_rules(out["features"], claims), k=12)
    return {p: out[p] for p in parts}
