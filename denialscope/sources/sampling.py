"""Daily batch selection: deterministic exact-n sample, incremental ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_key(seed) -> F.Column:
    return F.md5(F.concat(F.col("claim_id").cast("string"), F.lit(f"|{seed}")))


def daily_batch(claims: DataFrame, seed: int, n: int) -> DataFrame:
    """min(n, |claims|) claims without replacement, chosen by a seeded
    hash order (seed = day of month). ``orderBy + limit`` plans as a
    TakeOrderedAndProject: each task keeps its n best rows, so only
    n × tasks rows ever reach the final merge — bounded, whatever the input."""
    return claims.orderBy(sample_key(seed), F.col("claim_id")).limit(n)


def ingest_since(claims: DataFrame, since: str, date_col: str = "submission_date") -> DataFrame:
    """Claims submitted after the last run (pushed down to the scan)."""
    return claims.where(F.col(date_col) > F.lit(since).cast("date"))
