"""Feature frames: wide (raw + 23 features), model input, serving policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import feature_exprs
from ..sources.schema import DEFAULT_PROVIDER_RATE, FEATURE_COLUMNS
from . import history as H


def attach_provider_rate(claims: DataFrame, method="loo", label: str = "is_denied") -> DataFrame:
    """Add ``provider_historical_denial_rate`` by one of:

    * ``"loo"`` — leave-one-out over the same labelled claims (faithful form);
    * ``"loo_by_provider"`` — the same, with the rows dealt out by provider, for
      callers whose ties follow the order of rows;
    * ``"rolling_90d"`` — point-in-time 90-day window (production form);
    * ``"default"`` — constant 0.25 (single-claim serving default);
    * a labelled ``DataFrame`` — full-history rate from that table (J8);
    * a ``RollingHistory`` — point-in-time rate from a labelled table;
    * a ``StoredDays`` — the same from a maintained table of provider days.
    """
    if isinstance(method, H.StoredDays):
        return H.with_stored_days(claims, method)
    if isinstance(method, H.RollingHistory):
        return H.with_rolling_history(claims, method, label)
    if isinstance(method, DataFrame):
        return H.with_history_rate(claims, method, label)
    if method in ("loo", "loo_by_provider"):
        return H.with_loo_rate(claims, label, written=method == "loo")
    if method == "rolling_90d":
        return H.with_rolling_rate(claims, 90, label)
    if method == "default":
        return claims.withColumn(H.RATE, F.lit(DEFAULT_PROVIDER_RATE))
    raise ValueError(f"unknown provider history method {method!r}")


def features_wide(claims: DataFrame, provider_history="loo", policy: str = "batch",
                  label: str = "is_denied") -> DataFrame:
    """every raw column plus the 23 features, one projection."""
    with_rate = attach_provider_rate(claims, provider_history, label)
    exprs = feature_exprs(policy, provider_rate=F.col(H.RATE))
    raw = [c for c in with_rate.columns if c != H.RATE and c not in exprs]
    return with_rate.select(*raw, *[e.alias(n) for n, e in exprs.items()])


def missing_features(df: DataFrame) -> list[str]:
    """Model features that the frame lacks, sorted."""
    return sorted(set(FEATURE_COLUMNS) - set(df.columns))


def check_feature_columns(df: DataFrame) -> None:
    """Fail at plan time if any model feature is missing."""
    missing = missing_features(df)
    if missing:
        raise ValueError(f"Missing features after engineering: {missing}")


def model_input(features: DataFrame, keep: tuple[str, ...] = ("claim_id",)) -> DataFrame:
    """key columns + the 23 features in order, null and NaN → 0."""
    check_feature_columns(features)
    keep = [k for k in keep if k in features.columns]
    out = features.select(*keep, *FEATURE_COLUMNS)
    return out.na.fill(0, subset=FEATURE_COLUMNS)


def training_input(claims: DataFrame, keep: tuple[str, ...] = ("claim_id", "is_denied"), label: str = "is_denied") -> DataFrame:
    """``model_input`` of ``features_wide`` with 90-day rates. The other features
    come first, so that the join of the rates shuffles them and no raw columns."""
    exprs = feature_exprs("batch", provider_rate=F.col(H.RATE))
    needed = dict.fromkeys(c for c in (*keep, "claim_id", H.NPI, "service_date", label) if c in claims.columns and c not in exprs)
    early = claims.select(*needed, *[e.alias(n) for n, e in exprs.items() if n != H.RATE])
    return model_input(attach_provider_rate(early, "rolling_90d", label).withColumn(H.RATE, exprs[H.RATE]), keep)


def features_serve_policy(claims: DataFrame, provider_history="default") -> DataFrame:
    """single-claim defaults applied as a table job."""
    return features_wide(claims, provider_history=provider_history, policy="serve")
