"""Global-order running sums without a single-partition window.

``Window.orderBy(x)`` with no partition moves every row into one task. For
curves (ROC, PR), exact quantiles, average precision and fold assignment we
need cumulative counts in global order, so we use a two-level prefix sum:

1. approximate quantiles of a numeric, order-preserving bucket key give the
   boundaries of ranges of about ``ROWS_PER_BUCKET`` rows, so their number
   grows with the input;
   ``Bucketizer`` (binary search, JVM side) assigns each row an ordered
   bucket — a deterministic function of the key, so recomputation after an
   executor loss yields the same buckets;
2. a window partitioned by (group, bucket) computes running sums inside
   buckets, ordered by the exact order columns;
3. per-(group, bucket) totals become bucket offsets and are joined back (one
   row a bucket: Spark broadcasts them where they are small).

The input is read several times, so it is checkpointed first unless the caller
says that it is already written.

Inputs should be pre-aggregated to one row per distinct order key where
that is possible, so a hot key is a single row and cannot skew a bucket.
"""

from __future__ import annotations

import math
import uuid

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from ..sources import files

BUCKET = "__bucket"
ROWS_PER_BUCKET = 200_000


def running_sums(df: DataFrame, key: str, value_cols: list[str],
                 order_cols: list[Column] | None = None, group_cols: tuple[str, ...] = (),
                 n_buckets: int | None = None, written: bool = False) -> DataFrame:
    """Add ``cum_<v>``: inclusive running sum of ``v`` in ascending order.

    ``key`` is a numeric column that is non-decreasing in the order; when it
    is not unique, ``order_cols`` must complete it to a strict total order.
    ``group_cols`` restart the sums per group (e.g. per class label).
    """
    df = df if written else cut_lineage(df)
    n_buckets = n_buckets or max(4, math.ceil(df.count() / ROWS_PER_BUCKET))
    rel_error = 1 / (4 * n_buckets)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = sorted({b for b in df.approxQuantile(key, probs, rel_error)
                     if b is not None and not math.isnan(b)})
    splits = [-math.inf] + bounds + [math.inf]
    keyed = df.withColumn("__k", F.col(key).cast("double"))
    bucketed = Bucketizer(splits=splits, inputCol="__k", outputCol=BUCKET,
                          handleInvalid="keep").transform(keyed).drop("__k")
    if order_cols is not None:
        # dealt out before the window asks for it: what the rows are ordered by
        # (a digest) is computed behind the shuffle and does not travel
        # (by whole numbers: of doubles the window would want normalized ones)
        bucketed = bucketed.withColumn(BUCKET, F.col(BUCKET).cast("int")).repartition(*group_cols, BUCKET)
    order = order_cols if order_cols is not None else [F.col(key).asc()]
    w = (Window.partitionBy(*group_cols, BUCKET).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = bucketed.select("*", *[F.sum(v).over(w).alias(f"__in_{v}") for v in value_cols])
    totals = bucketed.groupBy(*group_cols, BUCKET).agg(*[F.sum(v).alias(f"__tot_{v}") for v in value_cols])
    # one row a (group, bucket)
    wb = Window.partitionBy(*group_cols).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group_cols, BUCKET,
                            *[F.coalesce(F.sum(f"__tot_{v}").over(wb), F.lit(0)).alias(f"__off_{v}")
                              for v in value_cols])
    if order_cols is not None:  # written, the planner knows how small they are and leaves the rows where they are
        offsets = files.materialize(offsets, scratch_path(df.sparkSession, f"offsets/{uuid.uuid4().hex}"))
    out = _join_null_safe(within, offsets, [*group_cols, BUCKET])
    return out.select(*df.columns, *[(F.col(f"__in_{v}") + F.col(f"__off_{v}")).alias(f"cum_{v}")
                                     for v in value_cols])


def _join_null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which null keys meet."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") for c in on], *[c for c in right.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(renamed, cond).drop(*[f"__r_{c}" for c in on])


BRACKET = 0.002


def exact_quantile(df: DataFrame, col: str, q: float, alias: str = "quantile") -> DataFrame:
    """Exact linear-interpolation quantile (``quantile_cont``) as a 1-row frame.

    Approximate quantiles bracket the wanted rank; values below the bracket
    are only counted, and only those inside are ranked (distinct values, by
    ``running_sums``). Should the bracket miss the rank, all are.
    """
    x = F.col(col).cast("double")
    vals = df.select(x.alias(col)).where(F.col(col).isNotNull() & ~F.isnan(col))
    edges = vals.approxQuantile(col, [max(0.0, q - BRACKET), min(1.0, q + BRACKET)], BRACKET / 2)
    spark = df.sparkSession
    if not edges:
        return spark.createDataFrame([(None,)], f"{alias} DOUBLE")
    for low, high in (edges, (-math.inf, math.inf)):
        n, below, inside = vals.agg(F.count(F.lit(1)), F.sum((F.col(col) < low).cast("long")),
                                    F.sum(F.col(col).between(low, high).cast("long"))).first()
        h = (n - 1) * q
        lo, hi = math.floor(h), math.ceil(h)
        if below <= lo and hi < below + inside:
            break
    counts = cut_lineage(vals.where(F.col(col).between(low, high)).groupBy(col).agg(F.count(F.lit(1)).alias("__c")))
    cum = running_sums(counts, col, ["__c"], written=True)
    start, end = F.col("cum___c") - F.col("__c") + below, F.col("cum___c") + below
    pick = lambda k: F.max(F.when((start <= k) & (F.lit(k) < end), F.col(col)))
    a, b = cum.agg(pick(lo), pick(hi)).first()
    return spark.createDataFrame([(a + (b - a) * (h - lo),)], f"{alias} DOUBLE")


def hash_order_key(col: str, seed: str) -> tuple[Column, list[Column]]:
    """Deterministic pseudo-random order by ``md5(col‖'|'‖seed)``: returns a
    numeric bucket key (first 13 hex digits, order-preserving) and the exact
    order columns (full digest, then the id)."""
    digest = F.md5(F.concat(F.col(col).cast("string"), F.lit("|" + seed)))
    key = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return key, [digest.asc(), F.col(col).asc()]
