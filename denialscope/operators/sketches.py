"""Mergeable quantiles (A10, A11): one KLL sketch a day and group, stored and
merged at query time. A range of days then costs its sketches and no scan of
claims; a new day adds its own. The exact form is ``kpis.billed_p95``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sketch size: values kept a level. A quantile's rank is off by at most
#: ``rank_error(K)`` of the rows, in 99 of 100 cases.
K = 800


def rank_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch at 99 % confidence (published
    fit of the sketch's authors)."""
    return 2.296 / k ** 0.9723


def day_sketches(claims: DataFrame, value: str = "billed_amount", by: tuple[str, ...] = ("claim_type",),
                 date_col: str = "service_date", k: int = K) -> DataFrame:
    """One row a (day, group): ``sketch`` of the values that are numbers.
    Partial sketches are built before the shuffle, so a hot group costs a sketch
    a task. Groups without a value have no row; a null day or group is one."""
    x = F.col(value).cast("double")
    kept = claims.where(x.isNotNull() & ~F.isnan(x))
    return kept.groupBy(F.col(date_col).alias("day"), *by).agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, qs: tuple[float, ...] = (0.5, 0.95), by: tuple[str, ...] = (), k: int = K) -> DataFrame:
    """One row a group and quantile: ``q``, ``value`` (a value of the data
    whose rank is about ``q``) and ``n`` (exact). No sketches: no rows."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("s"), F.count(F.lit(1)).alias("days"))
    n = F.kll_sketch_get_n_double("s").alias("n")
    cuts = [F.struct(F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double("s", F.lit(float(q))).alias("value"), n) for q in qs]
    return merged.where("days > 0").select(*by, F.inline(F.array(*cuts)))


def ranks(claims: DataFrame, values: DataFrame, value: str = "billed_amount") -> DataFrame:
    """For few ``values`` (column ``value``, with ``q``): the exact share of
    rows below and at most the value, by one pass over the claims."""
    wanted = [(r.q, r.value) for r in values.select("q", "value").collect()]
    x = F.col(value).cast("double")
    kept = claims.where(x.isNotNull() & ~F.isnan(x))
    shares = [F.struct(F.lit(q).alias("q"), F.avg((x < v).cast("double")).alias("below"), F.avg((x <= v).cast("double")).alias("at_most"))
              for q, v in wanted]
    if not shares:
        return claims.sparkSession.createDataFrame([], "q DOUBLE, below DOUBLE, at_most DOUBLE")
    return kept.agg(F.array(*shares).alias("a")).select(F.inline("a"))
