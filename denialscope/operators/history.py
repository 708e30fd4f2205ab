"""Provider denial history: leave-one-out rate, point-in-time rolling rate,
and history joins for unlabelled claims.

Scale notes. A provider can hold a third of all claims, so nothing here puts
all claims of one provider into one task:

* ``provider_stats`` is a hash aggregate (partial aggregation on the map side
  collapses a hot provider to one row per input partition before the shuffle).
* ``loo_rate`` writes those stats and joins them back with a plain equi-join:
  broadcast when the written table is small, else a sort-merge join of which
  AQE splits skewed partitions.
* claims without an NPI have no history; in the joins they carry a key of their
  own (``_spread_null``), or they would all meet in one task.
* ``rolling_rate_90d`` first collapses claims to one row per (provider, day),
  so the window's partition for a provider is bounded by the number of
  calendar days, not by its claim count.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files
from ..sources.schema import DEFAULT_PROVIDER_RATE

NPI = "provider_npi"
RATE = "provider_historical_denial_rate"


@dataclass
class RollingHistory:
    """Point-in-time provider rates from a labelled history table."""

    history: DataFrame
    days: int = 90


@dataclass
class StoredDays:
    """Point-in-time provider rates from a maintained table of provider days
    (``add_days``)."""

    path: str
    days: int = 90


def _spread_null(claims: DataFrame) -> DataFrame:
    """Join key ``__npi``: the NPI, or for null a value per claim that no
    provider has. It reads the claim id and nothing else; of frames without one
    it numbers the rows."""
    own = F.col("claim_id") if "claim_id" in claims.columns else F.monotonically_increasing_id().cast("string")
    return claims.withColumn("__npi", F.coalesce(F.col(NPI), F.concat(F.lit("\u0000"), own)))


def _look_up(claims: DataFrame, table: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Left join of ``table`` on the NPI and ``keys``."""
    keyed = _spread_null(claims)
    return keyed.join(table.withColumnRenamed(NPI, "__npi"), on=["__npi", *keys], how="left").drop("__npi")


def provider_stats(claims: DataFrame, label: str = "is_denied") -> DataFrame:
    """A1: per provider, denied sum and labelled-claim count (null NPI excluded)."""
    return (claims.where(F.col(NPI).isNotNull())
            .groupBy(NPI)
            .agg(F.sum(label).cast("bigint").alias("total_denied"),
                 F.count(label).alias("total_claims")))


def loo_expr(total_denied: Column, total_claims: Column, label: Column) -> Column:
    """A2: (S − y)/(n − 1), undefined (n = 1, unknown provider, null y) → 0.25, clip 0..1."""
    rate = F.try_divide((total_denied - label).cast("double"), (total_claims - 1).cast("double"))
    rate = F.coalesce(F.nanvl(rate, F.lit(None).cast("double")), F.lit(DEFAULT_PROVIDER_RATE))
    return F.least(F.greatest(rate, F.lit(0.0)), F.lit(1.0))


def with_loo_rate(claims: DataFrame, label: str = "is_denied", written: bool = True) -> DataFrame:
    """J1 + A2: leave-one-out provider rate as ``provider_historical_denial_rate``.

    Null NPIs never match the join, so they get the 0.25 default. The stats are
    written first: by their size the planner either broadcasts them, and the
    claims need no shuffle, or shuffles both sides. Not ``written``, the claims
    are always dealt out by provider.
    """
    stats = provider_stats(claims, label)
    if written:
        stats = files.materialize(stats, scratch_path(claims.sparkSession, f"provider_stats/{uuid.uuid4().hex}"))
    joined = _look_up(claims, stats)
    return (joined.withColumn(RATE, loo_expr(F.col("total_denied"), F.col("total_claims"), F.col(label)))
            .drop("total_denied", "total_claims"))


def with_loo_rate_window(claims: DataFrame, label: str = "is_denied") -> DataFrame:
    """The same rate as a window, over claims counted by (provider,
    label): a window partition has one row a label, whatever the provider
    holds. Claims of one provider and label share a rate."""
    per = claims.where(F.col(NPI).isNotNull()).groupBy(NPI, F.col(label).alias("__y")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(NPI)
    y = F.col("__y")
    s = F.sum(y * F.col("c")).over(w).cast("bigint")
    n = F.sum(F.when(y.isNotNull(), F.col("c")).otherwise(0)).over(w)
    rates = per.select(NPI, F.coalesce(y, F.lit(-1)).alias("__y"), loo_expr(s, n, y).alias("__rate"))
    keyed = claims.withColumn("__y", F.coalesce(F.col(label), F.lit(-1)))
    return _look_up(keyed, rates, ("__y",)).withColumn(RATE, F.coalesce("__rate", F.lit(DEFAULT_PROVIDER_RATE))).drop("__y", "__rate")


def day_number(d: Column) -> Column:
    return F.unix_date(d)


def provider_daily(claims: DataFrame, label: str = "is_denied",
                   date_col: str = "service_date") -> DataFrame:
    """Pre-aggregate to one row per (provider, day) with denied and claim counts."""
    return (claims.where(F.col(NPI).isNotNull() & F.col(date_col).isNotNull())
            .groupBy(NPI, day_number(F.col(date_col)).alias("day"))
            .agg(F.sum(label).cast("bigint").alias("denied"), F.count(label).alias("n")))


def rolling_rate_table(claims: DataFrame, days: int = 90, label: str = "is_denied",
                       date_col: str = "service_date") -> DataFrame:
    """W2 core: (provider, day) → denial rate over the ``days`` days before."""
    return _rolling(provider_daily(claims, label, date_col), days)


def _rolling(daily: DataFrame, days: int) -> DataFrame:
    w = Window.partitionBy(NPI).orderBy("day").rangeBetween(-days, -1)
    s = F.sum("denied").over(w)
    n = F.sum("n").over(w)
    return daily.select(NPI, "day", F.try_divide(s.cast("double"), n.cast("double")).alias("rolling_rate"))


def with_rolling_rate(claims: DataFrame, days: int = 90, label: str = "is_denied",
                      date_col: str = "service_date") -> DataFrame:
    """Point-in-time provider rate from claims in the ``days`` days before
    the claim's date (the claim itself and same-day claims excluded); no
    history, null NPI or null date → 0.25."""
    table = rolling_rate_table(claims, days, label, date_col)
    keyed = claims.withColumn("__day", day_number(F.col(date_col)))
    joined = _look_up(keyed, table.withColumnRenamed("day", "__day"), ("__day",))
    return (joined.withColumn(RATE, F.coalesce(F.col("rolling_rate"), F.lit(DEFAULT_PROVIDER_RATE)))
            .drop("rolling_rate", "__day"))


def with_rolling_history(claims: DataFrame, source: RollingHistory, label: str = "is_denied",
                         date_col: str = "service_date") -> DataFrame:
    """Point-in-time rate of (possibly unlabelled) claims: the provider's
    claims in ``source.history`` in the days before the claim's date."""
    return _rate_of_days(claims, provider_daily(source.history, label, date_col), source.days, date_col)


def _rate_of_days(claims: DataFrame, daily: DataFrame, days: int, date_col: str) -> DataFrame:
    asked = (claims.where(F.col(NPI).isNotNull() & F.col(date_col).isNotNull())
             .select(NPI, day_number(F.col(date_col)).alias("day")).distinct()
             .select(NPI, "day", F.lit(0).cast("bigint").alias("denied"), F.lit(0).cast("bigint").alias("n")))
    daily = daily.select(NPI, "day", "denied", "n").unionByName(asked)
    daily = daily.groupBy(NPI, "day").agg(F.sum("denied").alias("denied"), F.sum("n").alias("n"))
    table = _rolling(daily, days).withColumnRenamed("day", "__day")
    joined = _look_up(claims.withColumn("__day", day_number(F.col(date_col))), table, ("__day",))
    return joined.withColumn(RATE, F.coalesce("rolling_rate", F.lit(DEFAULT_PROVIDER_RATE))).drop("rolling_rate", "__day")


DAYS_SCHEMA = f"{NPI} STRING, day INT, denied BIGINT, n BIGINT, run STRING, month INT"


def _month(day: Column) -> Column:
    d = F.date_from_unix_date(day)
    return F.year(d) * 100 + F.month(d)


def add_days(claims: DataFrame, path: str, run: str, label: str = "is_denied", date_col: str = "service_date") -> None:
    """Add labelled claims to the table of provider days at ``path``. Counts
    add up, so each run writes its own under ``run``, by month; the same run
    again replaces what it wrote."""
    daily = provider_daily(claims.where(F.col(label).isNotNull()), label, date_col).withColumn("month", _month(F.col("day")))
    # a month's providers spread over files by their number, not by a month
    daily.write.mode("overwrite").partitionBy("month").parquet(files.join_path(path, f"run={run}"))


def stored_days(spark, path: str, first: int, last: int) -> DataFrame:
    """(provider, day, denied, n) for days ``first`` to ``last``: only their
    months are read, and of those only the row groups with such days."""
    table = spark.read.schema(DAYS_SCHEMA).option("basePath", path).parquet(path)
    months = F.col("month").between(*[int((d := _EPOCH + dt.timedelta(days=x)).year * 100 + d.month) for x in (first, last)])
    return table.where(months & F.col("day").between(first, last)).groupBy(NPI, "day").agg(F.sum("denied").alias("denied"), F.sum("n").alias("n"))


_EPOCH = dt.date(1970, 1, 1)


def with_stored_days(claims: DataFrame, source: StoredDays, date_col: str = "service_date") -> DataFrame:
    """Point-in-time rate from the maintained table, which is read from
    ``source.days`` before the first claim to the day before the last."""
    first, last = claims.agg(F.min(day_number(F.col(date_col))), F.max(day_number(F.col(date_col)))).first()
    if first is None:  # no dates, no history
        return claims.withColumn(RATE, F.lit(DEFAULT_PROVIDER_RATE))
    daily = stored_days(claims.sparkSession, source.path, first - source.days, last - 1)
    return _rate_of_days(claims, daily, source.days, date_col)


def history_rates(history: DataFrame, label: str = "is_denied") -> DataFrame:
    """Full-history provider rate S/n from a labelled history table."""
    return (provider_stats(history, label)
            .select(NPI, F.try_divide(F.col("total_denied").cast("double"),
                                      F.col("total_claims").cast("double")).alias("history_rate")))


def with_history_rate(claims: DataFrame, history: DataFrame, label: str = "is_denied") -> DataFrame:
    """Rate for (possibly unlabelled) claims from a separate labelled
    history; unknown or null provider → 0.25."""
    rates = history_rates(history, label)
    joined = _look_up(claims, rates)
    rate = F.coalesce(F.col("history_rate"), F.lit(DEFAULT_PROVIDER_RATE))
    return joined.withColumn(RATE, F.least(F.greatest(rate, F.lit(0.0)), F.lit(1.0))).drop("history_rate")
