"""Feature drift (PSI) and prediction-shift monitoring.

Both datasets are stacked and written once; pass 1 is one wide aggregate
(joint min/max, and mean and deviation per dataset, of every feature), pass 2
counts values per (feature, dataset, bin), with bins found by comparing against
the ten linspace edges. Groups are few (features × 2 × 10) and
fully combined map-side, so skew in any feature costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import np_round
from ..session import cut_lineage
from ..sources.schema import FEATURE_COLUMNS

# FIXED VALUES — PSI thresholds, bin count, smoothing, recommendation texts.
PSI_WARNING = 0.10
PSI_CRITICAL = 0.20
N_BINS = 10
EPS = 1e-6
REC_CRITICAL = ("RETRAIN RECOMMENDED: Significant distribution shift detected in {}. "
                "Model predictions may be unreliable.")
REC_WARNING = ("MONITOR: Moderate distribution shift detected in some features. "
               "Schedule a review but retraining may not be necessary yet.")
REC_STABLE = "No action needed. Feature distributions are stable."
HISTORICAL_MEAN = 0.25
HISTORICAL_STD = 0.05


def stacked(train: DataFrame, score: DataFrame, features: list[str]) -> DataFrame:
    """(dataset, feature columns as DOUBLE) for both frames, checkpointed to
    the shared folder: both passes read it, so the upstream feature pipeline
    runs once and no executor memory stays pinned."""
    def one(df, tag):
        return df.select(F.lit(tag).alias("dataset"), *[F.col(c).cast("double").alias(c) for c in features])
    return cut_lineage(one(train, "train").unionByName(one(score, "score")))


def wide_stats(stack: DataFrame, features: list[str]) -> dict:
    """A16 and the ranges in one pass: feature → lo, hi over both datasets,
    mean and sample deviation of each (bounded scalars)."""
    aggs = []
    for i, c in enumerate(features):
        v = F.nanvl(F.col(c), F.lit(None).cast("double"))
        aggs += [F.min(v).alias(f"lo_{i}"), F.max(v).alias(f"hi_{i}")]
        for tag, side in (("training", "train"), ("scoring", "score")):
            own = F.when(F.col("dataset") == side, F.col(c))
            aggs += [F.avg(own).alias(f"{tag}_mean_{i}"), F.stddev_samp(own).alias(f"{tag}_std_{i}")]
    row = stack.agg(*aggs).first()
    return {c: {k: row[f"{k}_{i}"] for k in ("lo", "hi", *PROFILE)} for i, c in enumerate(features)}


PROFILE = ("training_mean", "training_std", "scoring_mean", "scoring_std")


def present(train: DataFrame, score: DataFrame, features: list[str]) -> list[str]:
    """Features present in both frames, in the given order (absent ones skipped)."""
    return [c for c in features if c in train.columns and c in score.columns]


def psi(train: DataFrame, score: DataFrame, features: list[str] = FEATURE_COLUMNS,
        n_bins: int = N_BINS, stack: DataFrame | None = None, stats: dict | None = None) -> DataFrame:
    """K1: per feature PSI over ``n_bins`` equal-width bins on the joint range.

    Outer edges are ±inf, ε = 1e-6 per bin; 0 if a side is empty or min = max.
    """
    feats = present(train, score, features)
    stack = stack if stack is not None else stacked(train, score, feats)
    stats = stats or wide_stats(stack, feats)
    return psi_of_counts(stack.sparkSession, feats, bin_counts(stack, feats, stats, n_bins), stats, n_bins)


def inner_edges(lo: float | None, hi: float | None, n_bins: int = N_BINS) -> list[float]:
    """The edges between ``n_bins`` equal bins: i·step + lo, as linspace; none
    of an empty range."""
    if lo is None or lo == hi:
        return []
    return [float(i) * ((hi - lo) / float(n_bins)) + lo for i in range(1, n_bins)]


def bin_counts(stack: DataFrame, feats: list[str], stats: dict, n_bins: int = N_BINS) -> dict[tuple[int, int], int]:
    """(feature number, bin) → count; bins of the scoring side are ``n_bins``
    on. A value's bin is the number of interior edges ≤ it; counts go by
    (feature, dataset, bin): ≤ #features × 2 × n_bins groups, combined map-side."""
    def bin_of(c):
        # arithmetic guess, then exact correction against the literal edges
        # e(i) = i·step + lo (the guess is off by at most one near an edge)
        v = F.nanvl(F.col(c), F.lit(None).cast("double"))
        lo, hi = stats[c]["lo"], stats[c]["hi"]
        if not inner_edges(lo, hi, n_bins):
            return F.when(v.isNotNull(), F.lit(0))
        step = (hi - lo) / float(n_bins)
        guess = F.least(F.greatest(F.floor((v - F.lit(lo)) / F.lit(step)), F.lit(0)),
                        F.lit(n_bins - 1)).cast("int")

        def edge(i):
            return i.cast("double") * F.lit(step) + F.lit(lo)
        up = (guess < n_bins - 1) & (v >= edge(guess + 1))
        down = (guess > 0) & (v < edge(guess))
        return F.when(v.isNotNull(), guess + up.cast("int") - down.cast("int"))
    # (feature index, dataset·n_bins + bin) as two ints: cheap keys for the
    # map-side combined count; the result has ≤ #features × 2 × n_bins rows.
    is_score = (F.col("dataset") == "score").cast("int")
    codes = F.array(*[bin_of(c) + is_score * n_bins for c in feats])
    counts = (stack.select(F.posexplode(codes).alias("fi", "code")).where(F.col("code").isNotNull())
              .groupBy("fi", "code").agg(F.count(F.lit(1)).alias("n"))).collect()
    return {(r["fi"], r["code"]): r["n"] for r in counts}


def psi_of_counts(spark, feats: list[str], cell: dict, stats: dict, n_bins: int = N_BINS) -> DataFrame:
    """K1 from the counts of ``bin_counts``."""
    # Complete grid (every feature × bin, zero-filled) as a bounded local frame;
    # the PSI formula itself stays a Spark expression.
    grid = [(i, c, b, int(cell.get((i, b), 0)), int(cell.get((i, b + n_bins), 0)))
            for i, c in enumerate(feats) for b in range(n_bins)]
    full = spark.createDataFrame(grid, "fi INT, feature STRING, bin INT, e BIGINT, a BIGINT")
    tot = {i: (sum(g[3] for g in grid if g[0] == i), sum(g[4] for g in grid if g[0] == i))
           for i in range(len(feats))}
    ne = F.element_at(F.create_map(*[x for i, (e, _) in tot.items() for x in (F.lit(i), F.lit(e))]), F.col("fi"))
    na = F.element_at(F.create_map(*[x for i, (_, a) in tot.items() for x in (F.lit(i), F.lit(a))]), F.col("fi"))
    ep = (F.col("e") + EPS) / (ne + n_bins * EPS)
    ap = (F.col("a") + EPS) / (na + n_bins * EPS)
    per = full.groupBy("fi", "feature").agg(F.sum((ap - ep) * F.log(ap / ep)).alias("psi_raw"))
    degenerate = [i for i, c in enumerate(feats)
                  if tot[i][0] == 0 or tot[i][1] == 0 or not inner_edges(stats[c]["lo"], stats[c]["hi"], n_bins)]
    value = F.when(F.col("fi").isin(*degenerate), F.lit(0.0)).otherwise(F.col("psi_raw")) if degenerate \
        else F.col("psi_raw")
    return per.select((F.col("fi") + 1).cast("int").alias("feature_index"), "feature", value.alias("psi"))


def psi_status(p):
    return F.when(p >= PSI_CRITICAL, "critical").when(p >= PSI_WARNING, "warning").otherwise("stable")


def stacked_profile(stack: DataFrame, features: list[str], stats: dict | None = None) -> DataFrame:
    """A16 for both datasets, one row per feature."""
    stats = stats or wide_stats(stack, features)
    rows = [(c, *[stats[c][k] for k in PROFILE]) for c in features]
    return stack.sparkSession.createDataFrame(rows, "feature STRING, " + ", ".join(f"{k} DOUBLE" for k in PROFILE))


def drift_features(train: DataFrame, score: DataFrame, features: list[str] = FEATURE_COLUMNS,
                   stack: DataFrame | None = None) -> DataFrame:
    """K2: feature, PSI (6 dp), status, train/score mean and std (4 dp).

    ``stack`` may be given pre-built (dataset + feature columns, written)."""
    feats = present(train, score, features)
    stack = stack if stack is not None else stacked(train, score, feats)
    wide = wide_stats(stack, feats)
    return with_status(psi(train, score, feats, stack=stack, stats=wide), stacked_profile(stack, feats, wide))


def with_status(p: DataFrame, stats: DataFrame) -> DataFrame:
    """K2 from K1 and the profile of both sides, one row per feature."""
    j = p.join(F.broadcast(stats), on="feature", how="left")
    return j.select("feature_index", "feature", np_round(F.col("psi"), 6).alias("psi"),
                    psi_status(F.col("psi")).alias("status"),
                    *[np_round(F.col(c), 4).alias(c) for c in
                      ("training_mean", "training_std", "scoring_mean", "scoring_std")])


def drift_report(details: DataFrame, run_ts: str | None = None) -> DataFrame:
    """K3: one row: overall status, counts, warning and critical lists in
    feature order, recommendation naming the first five critical features."""
    ordered = F.array_sort(F.collect_list(F.struct("feature_index", "feature", "status")))
    agg = details.agg(ordered.alias("rows"), F.count(F.lit(1)).alias("n_features_monitored"))
    crit = F.transform(F.filter("rows", lambda r: r["status"] == "critical"), lambda r: r["feature"])
    warn = F.transform(F.filter("rows", lambda r: r["status"] == "warning"), lambda r: r["feature"])
    out = agg.select(
        "n_features_monitored",
        F.size(warn).alias("n_features_warning"), F.size(crit).alias("n_features_critical"),
        warn.alias("features_with_drift"), crit.alias("features_critical"))
    overall = (F.when(F.col("n_features_critical") > 0, "critical")
               .when(F.col("n_features_warning") > 0, "warning").otherwise("stable"))
    head, tail = REC_CRITICAL.split("{}")
    rec = (F.when(overall == "critical",
                  F.concat(F.lit(head), F.array_join(F.slice("features_critical", 1, 5), ", "), F.lit(tail)))
           .when(overall == "warning", F.lit(REC_WARNING)).otherwise(F.lit(REC_STABLE)))
    ts = F.lit(run_ts) if run_ts is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return out.select(ts.alias("timestamp"), overall.alias("overall_status"), "n_features_monitored",
                      "n_features_warning", "n_features_critical", "features_with_drift",
                      "features_critical", rec.alias("recommendation"))


def prediction_profile(pred: DataFrame, p_col: str = "p_denial") -> DataFrame:
    """Mean and population std of predicted probabilities."""
    return pred.agg(F.avg(p_col).alias("mean"), F.stddev_pop(p_col).alias("std"), F.count(p_col).alias("n"))


def prediction_shift(pred: DataFrame, p_col: str = "p_denial", historical_mean: float = HISTORICAL_MEAN,
                     historical_std: float = HISTORICAL_STD) -> DataFrame:
    """K4: z = |mean − historical| / max(std, 1e-6); > 3 critical, > 2 warning."""
    prof = prediction_profile(pred, p_col)
    z = F.abs(F.col("mean") - F.lit(historical_mean)) / F.lit(max(historical_std, 1e-6))
    return prof.select(np_round(F.col("mean"), 4).alias("current_denial_rate"),
                       F.lit(historical_mean).alias("historical_denial_rate"),
                       np_round(z, 2).alias("z_score"),
                       F.when(z > 3, "critical").when(z > 2, "warning").otherwise("stable").alias("status"))
