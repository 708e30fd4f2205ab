"""Validation split: one annotated pass, then valid / quarantine views.

``annotate`` computes the error list once per row; sinks should write the
annotated frame partitioned by ``is_valid`` (one scan, two outputs) rather
than running two filtered jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import validation as V


def annotate(claims: DataFrame, dx=None, px=None) -> DataFrame:
    errors = V.error_list(dx, px)
    return claims.withColumn("errors", errors).withColumn("is_valid", F.size("errors") == 0)


def normalize_valid(df: DataFrame) -> DataFrame:
    """Accepted rows: claim type lower-cased, POS defaulted to "11"."""
    return (df.withColumn("claim_type", F.lower("claim_type"))
            .withColumn("place_of_service", F.coalesce(F.col("place_of_service"), F.lit(V.DEFAULT_POS))))


def split_claims(claims: DataFrame, dx=None, px=None) -> tuple[DataFrame, DataFrame]:
    """V8: (valid, quarantine). Quarantine keeps every column plus ``errors``."""
    a = annotate(claims, dx, px)
    valid = normalize_valid(a.where("is_valid")).drop("errors", "is_valid")
    quarantine = a.where(~F.col("is_valid")).drop("is_valid")
    return valid, quarantine


def batch_sizes(claims: DataFrame, batch_col: str) -> DataFrame:
    """V9: per batch, claim count and whether it is within 1..1000."""
    return (claims.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n_claims"))
            .withColumn("batch_ok", (F.col("n_claims") >= 1) & (F.col("n_claims") <= V.MAX_BATCH))
            .withColumn("batch_error", F.when(~F.col("batch_ok"), F.lit(V.MSG_BATCH))))
