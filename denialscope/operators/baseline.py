"""Stored baselines for drift: the training side of the PSI, kept with a model.

A baseline is written once, when the model is trained, and read every day:

* ``profile``: range, mean and deviation of each feature;
* ``cells``: how many values lie in each of ``CELLS`` equal-width cells of a
  feature's range (at most features × ``CELLS`` rows);
* ``values``: each value with its count, sorted by (feature, cell) so that the
  row groups of one cell are found by their statistics.

The bins of a day lie on the joint range of both sides, so their edges move.
The count beyond an edge is that of the cells after the edge's cell, plus that
of the values beyond it in this one cell: exact wherever the edge falls, and
at most nine cells a feature are opened. Baselines of disjoint rows with the
same cells add up (``merged``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from ..sources.schema import FEATURE_COLUMNS
from . import drift as DR

CELLS = 4096


@dataclass
class Baseline:
    profile: DataFrame
    cells: DataFrame
    values: DataFrame

    @property
    def features(self) -> list[str]:
        return [r.feature for r in self.profile.orderBy("at").select("feature").collect()]


def _values(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value) of all values that are neither null nor NaN."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    return df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null and not isnan(value)")


def _cell(value, lo, hi):
    """Cell of a value; it never falls as the value rises."""
    at = F.floor((value - lo) / (hi - lo) * CELLS)
    return F.when(hi > lo, F.least(F.greatest(at, F.lit(-1)), F.lit(CELLS))).otherwise(F.when(value < lo, -1).when(value > hi, CELLS).otherwise(0)).cast("int")


def save_baseline(train: DataFrame, path: str, features: list[str] = FEATURE_COLUMNS) -> Baseline:
    """Write the baseline of ``train`` (read twice; hand in a written table)."""
    spark = train.sparkSession
    stack = train.select(F.lit("train").alias("dataset"), *[F.col(c).cast("double").alias(c) for c in features])
    stats = DR.wide_stats(stack, features)
    rows = [(k, c, stats[c]["lo"], stats[c]["hi"], stats[c]["training_mean"], stats[c]["training_std"]) for k, c in enumerate(features)]
    profile = spark.createDataFrame(rows, "at INT, feature STRING, lo DOUBLE, hi DOUBLE, mean DOUBLE, std DOUBLE")
    # one row a feature
    counted = (_values(train, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
               .join(F.broadcast(profile.select("feature", "lo", "hi")), "feature")
               .select("feature", _cell(F.col("value"), F.col("lo"), F.col("hi")).alias("cell"), "value", "n"))
    counted.repartitionByRange("feature", "cell", "value").sortWithinPartitions("feature", "cell", "value").write.mode("overwrite").parquet(files.join_path(path, "values"))
    values = spark.read.parquet(files.join_path(path, "values"))
    cells = values.groupBy("feature", "cell").agg(F.sum("n").alias("n"))
    cells.coalesce(1).write.mode("overwrite").parquet(files.join_path(path, "cells"))
    # the profile last: a baseline that has one is whole
    profile.coalesce(1).write.mode("overwrite").parquet(files.join_path(path, "profile"))
    return load_baseline(spark, path)


def load_baseline(spark: SparkSession, path: str) -> Baseline | None:
    """The baseline at ``path``; None if there is none (or half of one)."""
    if not files.exists(spark, files.join_path(path, "profile")):
        return None
    return Baseline(*[spark.read.parquet(files.join_path(path, name)) for name in ("profile", "cells", "values")])


def counts_beyond(base: Baseline, edges: dict[str, list[float]]) -> dict[tuple[str, int], int]:
    """(feature, k) → how many baseline values are at or beyond edge k."""
    spark = base.profile.sparkSession
    rows = [(c, k, e) for c, es in edges.items() for k, e in enumerate(es)]
    if not rows:
        return {}
    asked = spark.createDataFrame(rows, "feature STRING, k INT, edge DOUBLE").join(base.profile.select("feature", "lo", "hi"), "feature")
    asked = asked.select("feature", "k", "edge", _cell(F.col("edge"), F.col("lo"), F.col("hi")).alias("cut")).collect()
    table = F.broadcast(spark.createDataFrame(asked, "feature STRING, k INT, edge DOUBLE, cut INT"))  # nine rows a feature
    after = base.cells.join(table, "feature").where("cell > cut").groupBy("feature", "k").agg(F.sum("n").alias("n"))
    opened = opened_cells(base, {(r.feature, r.cut) for r in asked})
    inside = opened.join(table, "feature").where("cell = cut and value >= edge").groupBy("feature", "k").agg(F.sum("n").alias("n"))
    out = {(c, k): 0 for c, k, _ in rows}
    for r in after.unionByName(inside).collect():
        out[r.feature, r.k] += r.n
    return out


def opened_cells(base: Baseline, pairs: set) -> DataFrame:
    """Values of the given (feature, cell) pairs; the filter reaches the scan."""
    wanted = F.lit(False)
    for c in sorted({c for c, _ in pairs}):
        wanted = wanted | ((F.col("feature") == c) & F.col("cell").isin(sorted({k for f, k in pairs if f == c})))
    return base.values.where(wanted)


def drift_against(base: Baseline, score: DataFrame, n_bins: int = DR.N_BINS) -> DataFrame:
    """K2 of ``score`` against a stored baseline: what ``drift_features`` gives
    for the rows that the baseline was made of."""
    spark = score.sparkSession
    known = {r.feature: r for r in base.profile.collect()}
    feats = [c for c in base.features if c in score.columns]
    stack = score.select(F.lit("score").alias("dataset"), *[F.col(c).cast("double").alias(c) for c in feats])
    own = DR.wide_stats(stack, feats)
    stats = {}
    for c in feats:
        ends = lambda *v: [x for x in v if x is not None]
        stats[c] = own[c] | {"lo": min(ends(known[c].lo, own[c]["lo"]), default=None), "hi": max(ends(known[c].hi, own[c]["hi"]), default=None),
                             "training_mean": known[c].mean, "training_std": known[c].std}
    edges = {c: DR.inner_edges(stats[c]["lo"], stats[c]["hi"], n_bins) for c in feats}
    beyond = counts_beyond(base, edges)
    whole = {r.feature: r.n for r in base.cells.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    grid = DR.bin_counts(stack, feats, stats, n_bins)
    for i, c in enumerate(feats):
        steps = [whole.get(c, 0), *[beyond[c, k] for k in range(len(edges[c]))], 0]
        for b in range(len(steps) - 1):
            grid[i, b] = steps[b] - steps[b + 1]
    p = DR.psi_of_counts(spark, feats, grid, stats, n_bins)
    return DR.with_status(p, DR.stacked_profile(stack, feats, stats))


def merged(parts: list[Baseline], path: str) -> Baseline:
    """Baseline of several over disjoint rows. Their cells must have the same
    ranges; mean and deviation are taken from the values again."""
    spark = parts[0].profile.sparkSession
    ranges = {tuple((r.feature, r.lo, r.hi) for r in b.profile.orderBy("at").collect()) for b in parts}
    if len(ranges) != 1:
        raise ValueError("baselines of different ranges")
    values = parts[0].values
    for b in parts[1:]:
        values = values.unionByName(b.values)
    values = values.groupBy("feature", "cell", "value").agg(F.sum("n").alias("n"))
    values.repartitionByRange("feature", "cell", "value").sortWithinPartitions("feature", "cell", "value").write.mode("overwrite").parquet(files.join_path(path, "values"))
    values = spark.read.parquet(files.join_path(path, "values"))
    values.groupBy("feature", "cell").agg(F.sum("n").alias("n")).coalesce(1).write.mode("overwrite").parquet(files.join_path(path, "cells"))
    n, s = F.sum("n"), F.sum(F.col("n") * F.col("value"))
    mean = values.groupBy("feature").agg(n.alias("count"), (s / n).alias("mean"))
    square = values.join(F.broadcast(mean), "feature").groupBy("feature").agg(
        F.first("mean").alias("mean"), F.sqrt(F.try_divide(F.sum(F.col("n") * (F.col("value") - F.col("mean")) ** 2), F.first("count") - 1)).alias("std"))
    profile = parts[0].profile.drop("mean", "std").join(square, "feature", "left").select("at", "feature", "lo", "hi", "mean", "std")
    profile.coalesce(1).write.mode("overwrite").parquet(files.join_path(path, "profile"))
    return load_baseline(spark, path)
