"""Scorers and prediction records (batch form and serve form).

A scorer maps a feature frame to the same frame plus ``p_denial`` (the
unrounded probability). Two implementations: the deterministic rule
scorecard (exactly checkable in SQL) and any fitted Spark ML model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..sources.schema import FEATURE_COLUMNS, MODEL_VERSION, PREDICTION_THRESHOLD

P = "p_denial"


class RuleScorer:
    """R1 as a scorer (works on a wide feature frame: needs raw billed, POS, type)."""

    name = "rules"

    def score(self, features: DataFrame) -> DataFrame:
        return features.withColumn(P, R.rule_probability())


class ModelScorer:
    """Wraps a fitted model of ``operators.training``. Features are filled
    with 0, like the reference's model input."""

    def __init__(self, model, name: str = "model"):
        self.model = model
        self.name = name

    def score(self, features: DataFrame) -> DataFrame:
        from .training import score
        return score(self.model, features).withColumnRenamed("p_denial", P).drop("predicted")


def promoted_scorer(spark, models_dir: str | None) -> ModelScorer | None:
    """The model that the weekly job has promoted under ``models_dir``."""
    from .training import load_model, promoted_path
    path = promoted_path(spark, models_dir) if models_dir else None
    return ModelScorer(load_model(spark, path), name=path) if path else None


def predict_batch(features: DataFrame, scorer=None,
                  threshold: float = PREDICTION_THRESHOLD) -> DataFrame:
    """claim_id, probability (4 dp half-even), decision, band, reimbursement."""
    scorer = scorer or RuleScorer()
    scored = scorer.score(features)
    p = F.col(P)
    denied = R.predicted_denied(p, threshold)
    return scored.select(
        "claim_id",
        R.np_round(p, 4).alias("denial_probability"),
        denied.alias("predicted_denied"),
        R.confidence_batch(p).alias("confidence"),
        R.reimbursement_batch(denied).alias("estimated_reimbursement"),
    )


def predict_claims(features: DataFrame, scorer=None,
                   threshold: float = PREDICTION_THRESHOLD,
                   extra: tuple[str, ...] = ()) -> DataFrame:
    """Serve-form prediction record for every claim (feed serve-policy features)."""
    scorer = scorer or RuleScorer()
    scored = scorer.score(features)
    p = F.col(P)
    denied = R.predicted_denied(p, threshold)
    return scored.select(
        *extra,
        F.coalesce(F.col("claim_id"), F.lit("unknown")).alias("claim_id"),
        R.np_round(p, 4).alias("denial_probability"),
        denied.alias("predicted_denied"),
        R.denial_reasons(p).alias("denial_reasons"),
        R.reimbursement_serve(denied).alias("estimated_reimbursement"),
        R.confidence_serve(p).alias("confidence"),
        F.lit(MODEL_VERSION).alias("model_version"),
    )


def batch_summary(predictions: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Total, predicted denied, denial rate (0 when empty), per batch key."""
    aggs = [F.count(F.lit(1)).alias("total_claims"),
            F.coalesce(F.sum(F.col("predicted_denied").cast("bigint")), F.lit(0)).cast("bigint")
            .alias("total_predicted_denied")]
    g = predictions.groupBy(*keys) if keys else predictions.groupBy()
    out = g.agg(*aggs)
    return out.withColumn("batch_denial_rate",
                          F.coalesce(F.try_divide(F.col("total_predicted_denied").cast("double"),
                                                  F.col("total_claims").cast("double")), F.lit(0.0)))


def predict_batch_endpoint(features: DataFrame, batch_col: str = "batch_id", scorer=None,
                           threshold: float = PREDICTION_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Prediction records plus the per-batch summary (A15 keyed by batch)."""
    records = predict_claims(features, scorer, threshold, extra=(batch_col,))
    return records, batch_summary(records, (batch_col,))
