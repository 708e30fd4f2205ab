import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from denialscope.operators import training as TR
from denialscope.operators.features import features_wide, model_input
from denialscope.plans.daily import daily_scoring
from denialscope.sources import files
from denialscope.sources.published import read_published
from denialscope.sources.fixtures import TABLES, claims
from denialscope.streaming import jobs as J

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small_claims(spark):
    return claims(spark, SF001).cache()


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.count() == 3
    assert set(out.columns) == {"claim_type", "n_claims", "actual_denial_rate", "predicted_denial_rate",
                                "mean_probability"}


def test_every_query_has_docstring_and_oracle_mostly():
    qs, oracle = E.queries(), E.oracle_sql()
    assert len(qs) >= 100
    assert set(oracle) <= set(qs)
    assert len(oracle) / len(qs) > 0.75


FAST = ["f_submission_lag_days", "features_wide", "agg_provider", "win_provider_rate_90d", "validate_claims",
        "predict_claims", "kpi_billed_p95", "roc_curve", "psi", "drift_report", "explain_batch",
        "waterfall_top12", "sample_daily_batch", "stratified_folds", "class_weights"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    s = E.queries()[name](spark, SF001).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    cols = sorted(s.columns)

    def canon(df):
        return sorted(tuple("NULL" if v is None or v != v else repr(round(v, 6)) if isinstance(v, float) else str(v)
                            for v in rec) for rec in df[cols].astype(object).itertuples(index=False, name=None))
    assert canon(s) == canon(d)


def test_daily_pipeline_idempotent(spark, small_claims):
    out_dir = tempfile.mkdtemp(prefix="daily-")
    r1 = daily_scoring(small_claims, "2024-01-15", "2000-01-01", out_dir)
    due = small_claims.where("submission_date > '2000-01-01'").count()
    assert r1["predictions"].count() == due > 1000  # every claim since the last run
    r2 = daily_scoring(small_claims, "2024-01-15", "2000-01-01", out_dir)
    hist = read_published(spark, os.path.join(out_dir, "prediction_history"), "scored_date")
    assert hist.count() == due  # re-run replaced the partition
    assert r2["drift_report"].first()["n_features_monitored"] == 23


def test_daily_drift_of_the_same_claims_is_zero(spark, small_claims):
    """Both sides of the report define the provider rate alike."""
    out = daily_scoring(small_claims.where("submission_date is not null"), "2024-01-15", "1900-01-01",
                        tempfile.mkdtemp(prefix="daily-"), history=small_claims.where("submission_date is not null"))
    assert {r["psi"] for r in out["drift_details"].collect()} == {0.0}


def test_training_features_do_not_hold_the_label(spark, small_claims):
    """Point-in-time rates stay when a row's own label flips; leave-one-out
    rates of its neighbours would not."""
    some = small_claims.dropDuplicates(["claim_id"])
    flipped = some.withColumn("is_denied", F.when(F.col("claim_id") == some.agg(F.max("claim_id")).first()[0], 1 - F.col("is_denied")).otherwise(F.col("is_denied")))
    target = some.agg(F.max("claim_id")).first()[0]
    rate = lambda df: features_wide(df, provider_history="rolling_90d").where(F.col("claim_id") == target).first()["provider_historical_denial_rate"]
    assert rate(some) == rate(flipped)


def test_null_npi_and_rolling_history(spark, small_claims):
    from denialscope.operators.history import RollingHistory
    a = features_wide(small_claims, provider_history="rolling_90d").select("claim_id", "provider_historical_denial_rate")
    b = features_wide(small_claims.withColumn("is_denied", F.lit(None).cast("int")), provider_history=RollingHistory(small_claims)).select("claim_id", "provider_historical_denial_rate")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() == small_claims.count()
    nulls = features_wide(small_claims.withColumn("provider_npi", F.lit(None).cast("string")))
    assert {r[0] for r in nulls.select("provider_historical_denial_rate").distinct().collect()} == {0.25}


SMALL_FOREST = {"kind": "rf", "numTrees": 4, "maxDepth": 3, "minInstancesPerNode": 10, "weights": "balanced"}


def test_weekly_gate_and_versions(spark, small_claims):
    """First run deploys; a second of the same date is held back or keeps the
    first version as the backup. The daily job scores with what is promoted."""
    from denialscope.operators.scoring import ModelScorer, promoted_scorer
    from denialscope.plans.weekly import weekly_retrain
    base = tempfile.mkdtemp(prefix="weekly-")
    assert promoted_scorer(spark, f"{base}/models") is None
    one = weekly_retrain(small_claims, base, config_name="small", config=SMALL_FOREST)
    assert one["deployed_path"] and one["backup_path"] is None
    two = weekly_retrain(small_claims, base, config_name="small", config=SMALL_FOREST)
    row = two["summary"].first()
    assert row["deployed"] is False and row["production_holdout_auc"] is not None and row["production_whole_auc"] is not None
    forced = weekly_retrain(small_claims, base, config_name="small", config=SMALL_FOREST, min_gain=-1.0)
    assert forced["backup_path"] == one["deployed_path"] and os.path.isdir(one["deployed_path"])
    assert TR.promotions(spark, f"{base}/models") == [forced["deployed_path"], one["deployed_path"]]
    out = daily_scoring(small_claims, "2024-01-15", "2001-01-01", tempfile.mkdtemp(prefix="daily-"), models_dir=f"{base}/models")
    model = promoted_scorer(spark, f"{base}/models")
    assert isinstance(model, ModelScorer)
    want = TR.score(model.model, out["features"]).select(F.round("p_denial", 3).alias("p")).groupBy("p").count()
    got = out["predictions"].select(F.round("denial_probability", 3).alias("p")).groupBy("p").count()
    assert abs(want.agg(F.sum(F.col("p") * F.col("count"))).first()[0] - got.agg(F.sum(F.col("p") * F.col("count"))).first()[0]) < 1.0


def test_unlabelled_rows_take_no_part_in_training(spark, small_claims):
    mi = model_input(features_wide(small_claims), keep=("claim_id", "is_denied"))
    some = mi.withColumn("is_denied", F.when(F.hash("claim_id") % 5 != 0, F.col("is_denied")))
    assert 0 < TR.labelled(some).count() < some.count()
    model = TR.fit(some, SMALL_FOREST)
    assert abs(sum(v for _, v in TR.feature_importance(model)) - 1) < 1e-9


def test_logistic_fit_is_stationary(spark, small_claims):
    """The gradient of the penalised weighted loss vanishes at the fit."""
    import numpy as np
    from denialscope.sources.schema import FEATURE_COLUMNS
    mi = model_input(features_wide(small_claims, provider_history="rolling_90d"), keep=("claim_id", "is_denied"))
    lr = TR.fit(mi, TR.MODEL_CONFIGS["LogisticRegression"]).stages[-1]
    pdf = mi.select(*FEATURE_COLUMNS, "is_denied").toPandas().astype(float)
    x, y = pdf[FEATURE_COLUMNS].to_numpy(), pdf["is_denied"].to_numpy()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta = lr.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + lr.intercept)))
    scale = np.maximum(np.abs(x).max(axis=0), 1)
    grad = (x.T @ (w * (p - y)) + beta) / w.sum() / scale
    assert np.abs(grad).max() < 0.02 and abs((w * (p - y)).sum() / w.sum()) < 0.02


def test_csv_roundtrip_exact(spark, small_claims):
    path = tempfile.mkdtemp(prefix="csv-")
    files.write_claims_csv(small_claims, path)
    back = files.read_claims_csv(spark, path).drop("_corrupt_record", "date_error")
    assert back.exceptAll(small_claims).count() == 0 and small_claims.exceptAll(back).count() == 0


def test_stream_ingest_equals_batch(spark, small_claims):
    base = tempfile.mkdtemp(prefix="stream-")
    for k in J.stage_ranges(small_claims, f"{base}/staged", ["1997-01-01", "1999-01-01"]):
        J.arrive(spark, f"{base}/staged", k, f"{base}/src")
        out = J.stream_ingest(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    # one claim id repeats at sf0.001: dedup keeps one of the two rows
    assert out.count() == small_claims.select("claim_id").distinct().count()


def test_stream_score_equals_batch(spark, small_claims):
    from denialscope.operators import scoring as SC
    from denialscope.operators import validate as VA
    base = tempfile.mkdtemp(prefix="xscore-")
    files.write_parquet(small_claims, f"{base}/src")
    out = J.stream_score(spark, f"{base}/src", f"{base}/out", history=small_claims, checkpoint=f"{base}/ck")
    valid, quarantine = VA.split_claims(small_claims)
    batch = SC.predict_claims(features_wide(valid, provider_history=small_claims, policy="serve"))
    cols = ["claim_id", "denial_probability", "predicted_denied", "estimated_reimbursement", "confidence"]
    assert out.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert out.count() == batch.count()
    q = J.read_batches(spark, f"{base}/out", "quarantine")
    assert q.count() == quarantine.count() > 0


def test_folds_balanced_and_gate(spark, small_claims):
    mi = model_input(features_wide(small_claims), keep=("claim_id", "is_denied"))
    f = TR.stratified_folds(mi).groupBy("is_denied", "fold").count().collect()
    for cls in (0, 1):
        sizes = [r["count"] for r in f if r["is_denied"] == cls]
        assert max(sizes) - min(sizes) <= 1
    assert TR.deploy_decision(0.005, None)["deploy"] is False  # improvement exactly 0.005: strict
    assert TR.deploy_decision(0.81, 0.8)["deploy"] is True
    assert TR.deploy_decision(0.80, 0.8)["deploy"] is False
    assert TR.deploy_decision(0.6, None)["production_auc"] == 0.0


def test_train_all_models_loop(spark, small_claims):
    # the selection loop with two small candidate configurations (test-sized)
    mi = model_input(features_wide(small_claims), keep=("claim_id", "is_denied"))
    configs = {"LogisticRegression": TR.MODEL_CONFIGS["LogisticRegression"],
               "SmallForest": {"kind": "rf", "numTrees": 5, "maxDepth": 3, "minInstancesPerNode": 10,
                               "weights": "balanced"}}
    store = tempfile.mkdtemp(prefix="store-") + "/s"
    out = TR.train_all_models(mi, configs=configs, save_path=tempfile.mkdtemp(prefix="best-") + "/m", store=store)
    assert out["importance"].count() == 2 * 23
    # a second run finds every fit in the store and makes none
    before = spark.read.schema(TR.RESULTS).json(store + "/results/*").count()
    again = TR.train_all_models(mi, configs=configs, store=store)
    assert spark.read.schema(TR.RESULTS).json(store + "/results/*").count() == before
    assert again["best_model"] == out["best_model"]
    assert out["metrics"].count() == 2 * 5 * 5
    assert out["best_model"] in configs
    comp = TR.model_comparison(out["metrics"], out["timing"]).collect()
    assert len(comp) == 2
    best = TR.best_model(out["metrics"], list(configs)).first()["model"]
    assert best == out["best_model"]


def test_lr_fit_and_roundtrip(spark, small_claims):
    from pyspark.ml import PipelineModel
    mi = model_input(features_wide(small_claims), keep=("claim_id", "is_denied"))
    m = TR.fit(mi, TR.MODEL_CONFIGS["LogisticRegression"])
    path = tempfile.mkdtemp(prefix="model-") + "/lr"
    m.write().overwrite().save(path)
    a = sorted(r[0] for r in TR.score(m, mi).select("p_denial").collect())
    b = sorted(r[0] for r in TR.score(PipelineModel.load(path), mi).select("p_denial").collect())
    assert len(a) == len(b) and max(abs(x - y) for x, y in zip(a, b)) < 1e-12


def test_stored_fits_are_named_by_what_made_them(spark, small_claims, monkeypatch):
    configs = {"TinyForest": {"kind": "rf", "numTrees": 2, "maxDepth": 2, "minInstancesPerNode": 10, "weights": "balanced"}}
    names = {TR.run_name("rows", configs), TR.run_name("other rows", configs)}
    for key, value in (("SEED", 43), ("N_FOLDS", 2), ("TREES", {**TR.TREES, "checkpointInterval": 5})):
        with monkeypatch.context() as m:
            m.setattr(TR, key, value)
            names.add(TR.run_name("rows", configs))
    with monkeypatch.context() as m:
        m.setattr(TR.inspect, "getsource", lambda module: "changed")
        names.add(TR.run_name("rows", configs))
    assert len(names) == 6 and TR.run_name("rows", configs) in names
    monkeypatch.setattr(TR, "N_FOLDS", 2)
    mi = model_input(features_wide(small_claims), keep=("claim_id", "is_denied"))
    store = tempfile.mkdtemp(prefix="store-") + "/s"
    for kept in (0, 2):
        out = TR.train_all_models(mi, configs=configs, store=store, save_path=store + "/best")
        assert TR.model_comparison(out["metrics"], out["timing"]).first()["stored_fits"] == kept
    from pyspark.ml import PipelineModel
    assert PipelineModel.load(store + "/best").stages


def test_weekly_job_promotes_a_boosted_model(spark, small_claims):
    """Folds and candidate of one run; the daily job scores with it."""
    from denialscope.operators.boosting import BoostedModel
    from denialscope.operators.scoring import promoted_scorer
    from denialscope.plans.weekly import weekly_retrain
    base = tempfile.mkdtemp(prefix="weekly-")
    config = TR.MODEL_CONFIGS["BoostedTrees"] | {"rounds": 4, "depth": 3}
    done = weekly_retrain(small_claims, base, config_name="small", config=config)
    assert done["deployed_path"] and isinstance(promoted_scorer(spark, f"{base}/models").model, BoostedModel)
    out = daily_scoring(small_claims, "2024-01-15", "2001-01-01", tempfile.mkdtemp(prefix="daily-"), models_dir=f"{base}/models")
    assert out["predictions"].where("denial_probability between 0 and 1").count() == out["batch"].count()
