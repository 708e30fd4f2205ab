"""Q1 — daily scoring job: ingest → features → score → store → monitor.

One Spark application. Every claim submitted since the run before is scored.
The batch and its features are written to shared storage (lineage cuts: a lost
executor recomputes from those files, not from the raw claims). Provider rates
come from a maintained table of provider days, and drift is measured against
the model's stored baseline: neither the history nor the training table is read
again once these exist. The history
store is a published table (``sources/published.py``): a day appears in one
commit, and a re-run of it replaces it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import drift as DR
from ..operators.baseline import drift_against, load_baseline, save_baseline
from ..operators.features import features_wide, model_input
from ..operators.history import RollingHistory, StoredDays, add_days
from ..operators.scoring import RuleScorer, predict_batch, promoted_scorer
from ..sources import files
from ..sources.published import publish, read_published
from ..sources.sampling import ingest_since


def score_batch(batch: DataFrame, history: DataFrame, scorer=None) -> tuple[DataFrame, DataFrame]:
    """Features for an (unlabelled) batch with point-in-time provider rates
    from the labelled history, then batch predictions. Returns (features,
    predictions)."""
    feats = features_wide(batch, provider_history=RollingHistory(history))
    return feats, predict_batch(feats, scorer or RuleScorer())


def daily_scoring(claims: DataFrame, run_date: str, since: str, out_dir: str, history: DataFrame | None = None,
                  scorer=None, training: DataFrame | None = None, models_dir: str | None = None) -> dict:
    """Run the five daily steps; returns frames read back from storage.

    ``claims`` is the claims source, of which all rows submitted after
    ``since`` are scored. Provider rates are point-in-time: from the labelled
    table ``history`` if one is given, else from the provider days kept under
    ``out_dir``, to which the first run adds all older claims of the source and
    every run its own labelled ones (labels that come later are a run of their
    own: ``add_days``). ``training`` is the labelled table the model was trained
    on (default: the source); it is read when the model has no baseline under
    ``out_dir`` yet. Both sides of the drift report have the same definition of
    the provider rate. The scorer is the given one, else the model promoted
    under ``models_dir``, else the rules.
    """
    training = training if training is not None else claims
    scorer = scorer or promoted_scorer(claims.sparkSession, models_dir) or RuleScorer()
    p = lambda *parts: files.join_path(out_dir, *parts)

    spark = claims.sparkSession
    batch = files.materialize(ingest_since(claims, since), p("daily_batch", f"run_date={run_date}"))
    if history is None:
        days = p("provider_days")
        if not files.exists(spark, files.join_path(days, "run=base")):
            late = F.coalesce(F.col("submission_date") > F.lit(since).cast("date"), F.lit(False))
            add_days(claims.where(~late), days, "base")
        add_days(batch, days, run_date)
    source = RollingHistory(history) if history is not None else StoredDays(p("provider_days"))
    # Wide features are written once; predictions and the model input both
    # read the written copy (no second pass through the history join).
    feats = files.materialize(features_wide(batch, provider_history=source),
                              p("daily_features", f"run_date={run_date}"))
    mi = model_input(feats)
    preds = predict_batch(feats, scorer).withColumn("scored_date", F.lit(run_date))
    publish(preds, p("prediction_history"), "scored_date", [run_date])
    stored = read_published(spark, p("prediction_history"), "scored_date", [run_date])

    name = os.path.basename(str(getattr(scorer, "name", "model")))
    base = load_baseline(spark, p("baselines", name))
    if base is None:
        # its own history: every provider day that is asked for is in the table itself
        train_mi = model_input(features_wide(training, provider_history="rolling_90d"), keep=())
        base = save_baseline(files.materialize(train_mi, p("baseline_input", name)), p("baselines", name))
    details = drift_against(base, mi)
    report_path = p("drift_reports", f"run_date={run_date}")
    report = DR.drift_report(details, run_ts=f"{run_date}T02:00:00")
    files.write_json(report, report_path)
    report = spark.read.schema(report.schema).json(report_path)
    status = report.select("overall_status").first()[0]
    return {"batch": batch, "features": mi, "predictions": stored, "drift_details": details,
            "drift_report": report, "alert": status == "critical",
            "summary": stored.agg(F.count(F.lit(1)).alias("n_scored"),
                                  F.sum(F.col("predicted_denied").cast("int")).alias("n_denied"))}
