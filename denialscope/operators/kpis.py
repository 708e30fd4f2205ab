"""KPI aggregates behind the overview page.

All are hash aggregates (partial + final), so skewed groups (one claim type
holding most rows) are absorbed by map-side combining. Quantiles are exact
and distributed (see ``operators.prefix.exact_quantile``), never a global
collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import prefix
from .procedures import pos_labels


def _rate():
    return F.avg(F.col("is_denied").cast("double"))


def summary_base(claims: DataFrame) -> DataFrame:
    """A3: dataset size and denial rate."""
    return claims.agg(F.count(F.lit(1)).alias("n_claims"), _rate().alias("denial_rate"))


def overview(claims: DataFrame) -> DataFrame:
    """A4: total claims, denial rate, mean billed amount."""
    return claims.agg(F.count(F.lit(1)).alias("total_claims"), _rate().alias("denial_rate"),
                      F.avg("billed_amount").alias("avg_billed"))


def by_claim_type(claims: DataFrame) -> DataFrame:
    """A5: denial rate and labelled count by claim type."""
    return (claims.where(F.col("claim_type").isNotNull()).groupBy("claim_type")
            .agg(_rate().alias("denial_rate"), F.count("is_denied").alias("n_claims")))


def monthly(claims: DataFrame) -> DataFrame:
    """Per service month (yyyy-MM): total, denied, approved."""
    m = F.date_format("service_date", "yyyy-MM")
    out = (claims.where(F.col("service_date").isNotNull()).groupBy(m.alias("service_month"))
           .agg(F.count("claim_id").alias("total"), F.sum("is_denied").cast("bigint").alias("denied")))
    return out.withColumn("approved", F.col("total") - F.col("denied"))


def by_specialty(claims: DataFrame) -> DataFrame:
    """Denial rate and count by provider specialty."""
    return (claims.where(F.col("provider_specialty").isNotNull()).groupBy("provider_specialty")
            .agg(_rate().alias("denial_rate"), F.count("is_denied").alias("n_claims")))


def top_specialties(claims: DataFrame, k: int = 10) -> DataFrame:
    """The k highest-denial specialties (name breaks ties), shown ascending."""
    top = by_specialty(claims).orderBy(F.desc("denial_rate"), F.asc("provider_specialty")).limit(k)
    return top.orderBy("denial_rate", F.desc("provider_specialty"))


def pos_breakdown(claims: DataFrame) -> DataFrame:
    """Claim counts by POS label, descending."""
    return (pos_labels(claims).groupBy("pos_label").agg(F.count(F.lit(1)).alias("n_claims"))
            .orderBy(F.desc("n_claims"), "pos_label"))


def billed_histogram(claims: DataFrame, n_bins: int = 50) -> DataFrame:
    """N equal-width bins over [min, max] of billed amount, by outcome.

    One bounded scalar pass for (min, max), then a map-side-combined count
    by (bin, is_denied)."""
    x = F.col("billed_amount")
    stats = claims.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = stats["lo"], stats["hi"]
    if lo is None:
        return claims.sparkSession.createDataFrame(
            [], "bin INT, is_denied INT, bin_start DOUBLE, bin_end DOUBLE, n_claims BIGINT")
    width = (hi - lo) / n_bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(n_bins - 1)).cast("int")
    out = (claims.where(x.isNotNull()).groupBy(b.alias("bin"), "is_denied")
           .agg(F.count(F.lit(1)).alias("n_claims")))
    return out.select("bin", "is_denied",
                      (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
                      "n_claims")


def billed_p95(claims: DataFrame, q: float = 0.95) -> DataFrame:
    """A10: exact linear-interpolated quantile of billed amount."""
    return prefix.exact_quantile(claims, "billed_amount", q, alias="billed_p95")


def generator_profile(claims: DataFrame) -> DataFrame:
    """Per claim type count, plus overall billed mean and exact median
    (two bounded scalars attached as literals)."""
    counts = claims.groupBy("claim_type").agg(F.count(F.lit(1)).alias("n_claims"))
    mean = claims.agg(F.avg("billed_amount")).first()[0]
    med = prefix.exact_quantile(claims, "billed_amount", 0.5, alias="m").first()[0]
    return (counts.withColumn("billed_mean", F.lit(mean).cast("double"))
            .withColumn("billed_median", F.lit(med).cast("double")))


def class_balance(claims: DataFrame, label: str = "is_denied") -> DataFrame:
    """Negatives, positives, pos_weight = neg/pos, positive ratio."""
    y = F.col(label)
    out = claims.agg(F.sum((y == 0).cast("bigint")).alias("n_negative"),
                     F.sum((y == 1).cast("bigint")).alias("n_positive"),
                     F.count(y).alias("n"))
    return (out.withColumn("pos_weight", F.try_divide(F.col("n_negative").cast("double"),
                                                      F.col("n_positive").cast("double")))
            .withColumn("pos_ratio", F.try_divide(F.col("n_positive").cast("double"),
                                                  F.col("n").cast("double"))))


def predicted_vs_actual_by_type(scored: DataFrame, p_col: str = "p_denial",
                                threshold: float = 0.5) -> DataFrame:
    """Flagship: per claim type, actual and predicted denial rates and mean p."""
    return (scored.groupBy("claim_type")
            .agg(F.count(F.lit(1)).alias("n_claims"),
                 _rate().alias("actual_denial_rate"),
                 F.avg((F.col(p_col) >= threshold).cast("double")).alias("predicted_denial_rate"),
                 F.avg(p_col).alias("mean_probability")))
