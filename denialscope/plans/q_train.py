"""Registered queries: training, selection, deploy gate, weekly retrain
(L1–L12, A18, T2, T7, S15, S16, Q2). Model features have point-in-time
provider rates."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..operators import boosting as B
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import scoring as SC
from ..operators import training as TR
from ..session import cut_lineage, scratch_path
from ..sources import files
from ..sources.fixtures import claims
from ..sources.schema import FEATURE_COLUMNS
from . import sqlparts as S
from .registry import ORACLE, register
from .weekly import weekly_retrain


def _stored(spark, d, keep=("claim_id", "is_denied")):
    """Labelled model input, written once as the features come."""
    mi = TR.labelled(FE.training_input(claims(spark, d), keep))
    return files.materialize_alone(mi, scratch_path(spark, f"model-input/{uuid.uuid4().hex}"))


def _mi(spark, d):
    """Model input written to the shared checkpoint folder: every fit
    re-reads it, and no executor memory stays pinned after the query."""
    mi = _stored(spark, d)
    return TR.training_frame(mi, n_rows=mi.count())


def _folds(spark, d):
    """The same with stratified folds, as the ranking leaves the rows; the ids
    are not needed any more."""
    folded = TR.stratified_folds(_stored(spark, d), written=True).drop("claim_id")
    return files.materialize_alone(folded, scratch_path(spark, f"training-frames/{uuid.uuid4().hex}"))


@register("class_weights", "WITH " + S.claims_cte() + """, cc AS (
  SELECT is_denied, COUNT(*) AS n FROM claims WHERE is_denied IS NOT NULL GROUP BY is_denied)
SELECT is_denied, n, CAST(SUM(n) OVER () AS DOUBLE) / (2.0 * n) AS balanced_weight,
  CASE WHEN is_denied = 1 THEN CAST(SUM(CASE WHEN is_denied = 0 THEN n END) OVER () AS DOUBLE)
       / SUM(CASE WHEN is_denied = 1 THEN n END) OVER () ELSE 1.0 END AS pos_weight
FROM cc""")
def q_class_weights(spark, d):
    """L1: balanced and positive-class weights."""
    return TR.class_weight_table(claims(spark, d))


@register("stratified_folds", "WITH " + S.claims_cte() + """
SELECT claim_id, is_denied, CAST((row_number() OVER (PARTITION BY is_denied
  ORDER BY md5(claim_id || '|42'), claim_id) - 1) % 5 AS INT) AS fold FROM claims WHERE is_denied IS NOT NULL""")
def q_folds(spark, d):
    """Stratified, seeded 5-fold assignment."""
    c = claims(spark, d).where(F.col("is_denied").isNotNull()).select("claim_id", "is_denied")
    return TR.stratified_folds(c)


def _fit_table(spark, d, name):
    """Importance rows of one fitted configuration. A linear fit adds up rows
    in any partitions and needs no more than its stored columns."""
    config = TR.MODEL_CONFIGS[name]
    mi = _stored(spark, d, ("is_denied",)) if config["kind"] == "lr" else _mi(spark, d)
    rows = TR.feature_importance(TR.fit(mi, config))
    return spark.createDataFrame([(name, f, v) for f, v in rows], "model STRING, feature STRING, importance DOUBLE")


@register("train_lr")
def q_train_lr(spark, d):
    """L2: balanced L2 logistic regression; |coefficients| per feature."""
    return _fit_table(spark, d, "LogisticRegression")


@register("train_rf")
def q_train_rf(spark, d):
    """L3: random forest 200 × depth 12, leaf ≥ 10, balanced; importances."""
    return _fit_table(spark, d, "RandomForest")


@register("train_gbt")
def q_train_gbt(spark, d):
    """L4: second-order boosting 300 × depth 8, lr .05, .8 row/column sampling;
    each feature's share of the gain."""
    return _fit_table(spark, d, "BoostedTrees")


@register("train_gbt_fast")
def q_train_gbt_fast(spark, d):
    """Leaf-wise boosting, 300 trees of 31 leaves, 255 bins."""
    return _fit_table(spark, d, "BoostedTreesFast")


_BIN = "CAST(least(greatest(floor({} * 4), 0), 31) AS INT)"


@register("boost_split_gains", S.with_(f"""fd AS (SELECT *, CAST((row_number() OVER (PARTITION BY is_denied
  ORDER BY md5(claim_id || '|42'), claim_id) - 1) % 5 AS INT) AS fold FROM feat WHERE is_denied IS NOT NULL)""", f"""r AS (SELECT fit, CASE WHEN submission_lag_days > 30 THEN 1 ELSE 0 END AS node,
  CASE WHEN is_denied = 1 THEN {S.D(-1.5)} ELSE {S.D(0.5)} END AS g, CASE WHEN is_denied = 1 THEN {S.D(0.75)} ELSE {S.D(0.25)} END AS h, fd.*
  FROM fd, (VALUES (0), (1), (2), (3), (4)) AS t(fit) WHERE fold <> fit)""", "c AS (" + " UNION ALL ".join(
    f"SELECT fit, node, '{f}' AS feature, {_BIN.format('coalesce(CAST(' + f + ' AS DOUBLE), 0)')} AS bin, SUM(g) AS g, SUM(h) AS h FROM r GROUP BY ALL" for f in FEATURE_COLUMNS) + ")",
    """n AS (SELECT *, SUM(g) OVER l AS gl, SUM(h) OVER l AS hl, SUM(g) OVER w AS ga, SUM(h) OVER w AS ha, MAX(bin) OVER w AS last FROM c
  WINDOW w AS (PARTITION BY fit, node, feature), l AS (PARTITION BY fit, node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING))""") + """
SELECT fit, node, feature, bin, (gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)) / 2 AS gain FROM n WHERE bin < last""")
def q_split_gains(spark, d):
    """The gain of every split of two nodes in all five folds' fits, at
    the first round's gradients (positives weigh 3)."""
    # null ids tie in the folds' order, where the order of rows decides
    wide = FE.features_wide(claims(spark, d), provider_history="loo_by_provider")
    mi = TR.labelled(FE.model_input(wide, keep=("claim_id", "is_denied")))
    node = (F.coalesce(F.col("submission_lag_days"), F.lit(0)) > 30).cast("int").alias("node")
    bins = [F.expr(_BIN.format(f"coalesce(CAST({f} AS DOUBLE), 0)")).cast("byte") for f in FEATURE_COLUMNS]
    # only bins take part from here on: the rows that the folds' checkpoint and
    # shuffle hold are a third as long, in the order that they had
    cells = mi.select("claim_id", "is_denied", node, F.array(*bins).alias("bins"))
    rows = TR.stratified_folds(cells).withColumn("fit", F.explode(F.sequence(F.lit(0), F.lit(4)))).where("fold <> fit")
    one = lambda a, b: F.when(F.col("is_denied") == 1, F.lit(a)).otherwise(F.lit(b))
    return B.split_gains(rows, {f: F.col("bins")[k] for k, f in enumerate(FEATURE_COLUMNS)}, one(-1.5, 0.5), one(0.75, 0.25), keys=["fit", "node"])


@register("feature_importance")
def q_importance(spark, d):
    """Importance table of the logistic model (|coef|)."""
    return _fit_table(spark, d, "LogisticRegression")


@register("rank_importance")
def q_rank_importance(spark, d):
    """Importance sorted descending (random forest)."""
    return _fit_table(spark, d, "RandomForest").orderBy(F.desc("importance"), "feature")


def _cv(spark, d, names):
    mi = _folds(spark, d)
    rows = []
    for n in names:
        rows.extend(TR.cross_validate(mi, TR.MODEL_CONFIGS[n], n))
    return spark.createDataFrame(rows, "model STRING, fold INT, metric STRING, value DOUBLE")


@register("cross_validate")
def q_cv(spark, d):
    """5-fold stratified CV of the logistic model (all five metrics)."""
    return _cv(spark, d, ["LogisticRegression"])


@register("cv_summary")
def q_cv_summary(spark, d):
    """CV metric mean and population std."""
    return TR.cv_summary(_cv(spark, d, ["LogisticRegression"]))


def _all(spark, d):
    """Results of one training run of all candidates, which the queries of one
    application share: it is kept under the application's id and a name made of
    the rows, the configurations and the training code. Nothing of another
    application is used. The winner is saved as ``best`` beside the fits."""
    feats = FE.features_wide(claims(spark, d), provider_history="rolling_90d")
    mi = cut_lineage(TR.labelled(FE.model_input(feats, keep=("claim_id", "is_denied", "service_date"))))
    n, digest = mi.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*mi.columns).cast("decimal(38,0)"))).first()
    store = scratch_path(spark, f"training/{spark.sparkContext.applicationId}/{TR.run_name(f'{n}|{digest}', TR.MODEL_CONFIGS)}")
    return TR.train_all_models(mi, store=store, save_path=files.join_path(store, "best"))


@register("train_all_models")
def q_train_all(spark, d):
    """CV all four candidates, refit, pick and save the best."""
    return _all(spark, d)["metrics"]


@register("model_comparison")
def q_model_comparison(spark, d):
    """One summary row per candidate."""
    r = _all(spark, d)
    return TR.model_comparison(r["metrics"], r["timing"])


@register("best_model")
def q_best_model(spark, d):
    """The winning candidate by mean CV AUC."""
    return TR.best_model(_all(spark, d)["metrics"], list(TR.MODEL_CONFIGS))


_LABELLED = "WITH " + S.claims_cte() + "\n"


@register("model_roundtrip", _LABELLED + f"SELECT claim_id, {S.D(0.0)} AS diff FROM claims WHERE is_denied IS NOT NULL")
def q_roundtrip(spark, d):
    """Save a fitted pipeline, load it back, score with both; the
    difference column must be zero."""
    mi = _mi(spark, d)
    model = TR.fit(mi, TR.MODEL_CONFIGS["LogisticRegression"])
    path = scratch_path(spark, f"models/{uuid.uuid4().hex}/lr")
    model.write().overwrite().save(path)
    again = TR.score(PipelineModel.load(path), TR.score(model, mi).withColumnRenamed("p_denial", "p_saved").drop("predicted"))
    return again.select("claim_id", F.abs(F.col("p_saved") - F.col("p_denial")).alias("diff"))


@register("score_model_batch", _LABELLED + """SELECT claim_id, true AS probability_ok, true AS decision_ok, true AS band_ok,
  true AS reimbursement_ok FROM claims WHERE is_denied IS NOT NULL""")
def q_score_model(spark, d):
    """R2 with a trained model: fit, promote, load what is promoted, score
    every claim, store the records; then each record's decision, band and
    reimbursement are recomputed from its stored probability."""
    base = scratch_path(spark, f"scoring/{uuid.uuid4().hex}")
    feats = TR.labelled(FE.training_input(claims(spark, d), ("claim_id", "is_denied", "allowed_amount", "billed_amount")))
    feats = files.materialize_alone(feats, f"{base}/features")
    TR.promote(spark, f"{base}/models", TR.fit(feats, TR.MODEL_CONFIGS["LogisticRegression"]), "2024-01-07")
    scorer = SC.promoted_scorer(spark, f"{base}/models")
    stored = files.materialize(SC.predict_batch(feats, scorer), f"{base}/predictions")
    p, paid = F.col("denial_probability"), F.col("estimated_reimbursement")
    pairs = stored.join(feats.select("claim_id", "allowed_amount", "billed_amount"), "claim_id")
    band = (F.when((p > 0) & (p <= 0.2), "high_approve").when(p <= 0.4, "medium").when(p <= 0.6, "low")
            .when(p <= 0.8, "medium").when(p <= 1, "high_deny"))
    due = F.when(F.col("predicted_denied"), 0.0).when(F.col("allowed_amount") > 0, F.col("allowed_amount")).otherwise(F.col("billed_amount") * 0.65)
    # the stored probability is rounded: at a border either side is right
    border = lambda *at: F.greatest(*[(F.abs(p - x) <= 5.1e-5).cast("int") for x in at]) == 1
    return pairs.select(
        "claim_id", p.between(0.0, 1.0).alias("probability_ok"),
        ((F.col("predicted_denied") == (p >= 0.5)) | border(0.5, 0.5)).alias("decision_ok"),
        (F.col("confidence").eqNullSafe(band) | border(0.0, 0.2, 0.4, 0.6, 0.8)).alias("band_ok"),
        (F.abs(paid - due) < 0.006).alias("reimbursement_ok"))


@register("ordered_folds", _LABELLED + """SELECT claim_id, is_denied, CAST(floor((r - 1) * 5 / n) AS INT) AS fold FROM (
  SELECT claim_id, is_denied, row_number() OVER (PARTITION BY is_denied ORDER BY service_date NULLS FIRST, md5(claim_id || '|ordered'), claim_id) AS r,
    COUNT(*) OVER (PARTITION BY is_denied) AS n FROM claims WHERE is_denied IS NOT NULL)""")
def q_ordered_folds(spark, d):
    """Unshuffled stratified folds in date order."""
    rows = TR.labelled(claims(spark, d)).select("claim_id", "is_denied", "service_date")
    return TR.ordered_folds(rows).select("claim_id", "is_denied", "fold")


@register("cross_validate_folds", _LABELLED + """, f AS (SELECT is_denied, (row_number() OVER (PARTITION BY is_denied
  ORDER BY md5(claim_id || '|42'), claim_id) - 1) % 5 AS fold FROM claims WHERE is_denied IS NOT NULL)
SELECT CAST(fold AS INT) AS fold, COUNT(*) AS n_test, CAST(SUM(is_denied) AS BIGINT) AS n_positive, true AS metrics_ok FROM f GROUP BY fold""")
def q_cv_folds(spark, d):
    """Size and positives of every held-out fold, and whether all its
    metrics are there and within 0 and 1."""
    mi = _folds(spark, d)
    rows = TR.cross_validate(mi, TR.MODEL_CONFIGS["LogisticRegression"], "LogisticRegression")
    ok = spark.createDataFrame(rows, "model STRING, fold INT, metric STRING, value DOUBLE").groupBy("fold").agg(
        ((F.count("value") == len(TR.METRICS)) & (F.min("value") >= 0) & (F.max("value") <= 1)).alias("metrics_ok"))
    sizes = mi.groupBy("fold").agg(F.count(F.lit(1)).alias("n_test"), F.sum("is_denied").cast("bigint").alias("n_positive"))
    return sizes.join(ok, "fold").select("fold", "n_test", "n_positive", "metrics_ok")


@register("missing_features", _LABELLED + "SELECT 'has_surgery|member_age' AS missing, COUNT(*) AS n_claims FROM claims")
def q_missing(spark, d):
    """What the check names when two features are absent."""
    wide = FE.features_wide(claims(spark, d)).drop("has_surgery", "member_age")
    missing = FE.missing_features(wide)
    return wide.agg(F.lit("|".join(missing)).alias("missing"), F.count(F.lit(1)).alias("n_claims"))


@register("sink_model_artifacts", ORACLE["classification_report"])
def q_artifacts(spark, d):
    """Classification report written as JSON and read back."""
    scored = SC.RuleScorer().score(FE.features_wide(claims(spark, d)))
    pred = scored.withColumn("predicted", (F.col(SC.P) >= 0.5).cast("int"))
    report = M.classification_report(M.confusion_matrix(pred))
    path = scratch_path(spark, f"artifacts/{uuid.uuid4().hex}/classification_report")
    files.write_json(report, path)
    return spark.read.schema(report.schema).json(path)


@register("sink_fitted_artifacts", _LABELLED + """SELECT 'importance' AS artifact, 23 AS n_rows, COUNT(*) AS n_claims, true AS ok
  FROM claims WHERE is_denied IS NOT NULL UNION ALL SELECT 'report', 5, COUNT(*), true FROM claims WHERE is_denied IS NOT NULL""")
def q_fitted_artifacts(spark, d):
    """Importance table and classification report of a fitted forest
    written and read back; ``ok``: importances sum to 1, supports to all."""
    mi = _mi(spark, d)
    config = TR.MODEL_CONFIGS["RandomForest"]
    model = TR.fit(mi, config)
    base = scratch_path(spark, f"artifacts/{uuid.uuid4().hex}")
    imp = spark.createDataFrame(TR.feature_importance(model), "feature STRING, importance DOUBLE")
    files.write_parquet(imp.coalesce(1), f"{base}/feature_importance")
    report = M.classification_report(M.confusion_matrix(TR.score(model, mi)))
    files.write_json(report, f"{base}/classification_report")
    imp = spark.read.parquet(f"{base}/feature_importance")
    rep = spark.read.schema(report.schema).json(f"{base}/classification_report")
    n = mi.count()
    one = imp.agg(F.lit("importance").alias("artifact"), F.count(F.lit(1)).cast("int").alias("n_rows"),
                  F.lit(n).cast("long").alias("n_claims"), (F.abs(F.sum("importance") - 1) < 1e-6).alias("ok"))
    two = rep.agg(F.lit("report").alias("artifact"), F.count(F.lit(1)).cast("int").alias("n_rows"),
                  F.sum(F.when(F.col("label").isin("0", "1"), F.col("support"))).alias("n_claims"),
                  (F.max(F.when(F.col("label") == "accuracy", F.col("f1_score"))).between(0.0, 1.0)).alias("ok"))
    return one.unionByName(two)


def _auc_ctes(prefix, src):
    w = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return [f"""{prefix}cnt AS (SELECT p_denial AS s, SUM(CASE WHEN is_denied = 1 THEN 1 ELSE 0 END) AS pos,
  SUM(CASE WHEN is_denied <> 1 THEN 1 ELSE 0 END) AS neg FROM {src}
  WHERE p_denial IS NOT NULL AND is_denied IS NOT NULL GROUP BY 1)""",
            f"""{prefix}auc AS (SELECT SUM(pos * (nb + neg * 0.5)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) AS auc FROM (
  SELECT pos, neg, SUM(neg) OVER (ORDER BY s {w}) - neg AS nb FROM {prefix}cnt))"""]


_SERVE_SC = ("sc2 AS (SELECT claim_id, is_denied, least(greatest(" + S.rule_sql().replace(
    "provider_historical_denial_rate", S.D(0.25)) + f", {S.D(0.02)}), {S.D(0.95)}) AS p_denial FROM feat)")


@register("deploy_gate", S.with_(_SERVE_SC, *_auc_ctes("c_", "sc"), *_auc_ctes("p_", "sc2"), scored=True) + """
SELECT c.auc AS candidate_auc, p.auc AS production_auc, c.auc - p.auc AS improvement,
  c.auc - p.auc > 0.005 AS deploy FROM c_auc c, p_auc p""")
def q_deploy_gate(spark, d):
    """candidate = scorer with provider history, production = scorer
    with the 0.25 default; deploy iff AUC gain > 0.005 (strict)."""
    f = FE.features_wide(claims(spark, d))
    both = cut_lineage(SC.RuleScorer().score(SC.RuleScorer().score(f).withColumnRenamed(SC.P, "p_cand").withColumn(
        "provider_historical_denial_rate", F.lit(0.25))).select("is_denied", "p_cand", SC.P))
    cand = M.auc(both.select("is_denied", F.col("p_cand").alias(SC.P))).first()[0]
    prod = M.auc(both.select("is_denied", SC.P)).first()[0]
    dec = TR.deploy_decision(cand, prod)
    return spark.createDataFrame([(dec["candidate_auc"], dec["production_auc"], dec["improvement"], dec["deploy"])],
                                 "candidate_auc DOUBLE, production_auc DOUBLE, improvement DOUBLE, deploy BOOLEAN")


@register("weekly_retrain")
def q_weekly(spark, d):
    """Q2: weekly job — load, CV the boosting candidate, gate, deploy/skip."""
    base = scratch_path(spark, f"weekly/{uuid.uuid4().hex}")
    return weekly_retrain(claims(spark, d), base)["summary"]
