"""What several steps of a query read is made once and stored."""

import datetime as dt

import pytest

from denialscope import session
from denialscope.operators import explain as X
from denialscope.operators import features as FE
from denialscope.operators import training as TR
from denialscope.plans import catalog, q_explain, q_io, q_layout, q_train
from denialscope.sources import colocated as CO
from denialscope.sources import files
from denialscope.sources.schema import FEATURE_COLUMNS

ROWS = [{"is_denied": k % 3 == 0 and 1 or 0, "billed_amount": 50.0 * k, "provider_npi": str(5550001110 + k % 2)} for k in range(30)]


def seen(monkeypatch, module, name, place=0):
    """Whether each frame that ``module.name`` is called with is a stored one."""
    stored, fn = [], getattr(module, name)

    def spy(*args, **more):
        stored.append(bool(args[place].inputFiles()))
        return fn(*args, **more)
    monkeypatch.setattr(module, name, spy)
    return stored


@pytest.mark.parametrize("query", ["prediction_history", "published_history", "evolved_history"])
def test_predictions_are_scored_once(spark, claims_of, monkeypatch, query):
    monkeypatch.setattr(q_io, "claims", lambda s, d: claims_of(*ROWS))
    stored = seen(monkeypatch, files, "append_partition") if query == "prediction_history" else seen(monkeypatch, q_io.PB, "publish")
    got = catalog.QUERIES[query](spark, "")
    assert got.count() == (60 if query == "evolved_history" else 30)
    assert stored == [True, True]


@pytest.mark.parametrize("query", ["explain_batch", "explain_claims", "explain_claims_map"])
def test_explained_features_are_made_once(spark, claims_of, monkeypatch, query):
    monkeypatch.setattr(q_explain, "claims", lambda s, d: claims_of(*ROWS))
    stored = seen(monkeypatch, X, "explain_rules")
    got = catalog.QUERIES[query](spark, "").collect()
    assert len(got) == (30 * 23 if query == "explain_claims_map" else 30)
    assert stored == [True]


def test_zipped_map_entries_are_those_of_the_maps(spark, claims_of, monkeypatch):
    monkeypatch.setattr(q_explain, "claims", lambda s, d: claims_of(*ROWS))
    want = {}
    for r in X.explanation_records(q_explain._rules_expl(spark, "", "serve", values=True)).collect():
        for f, v in r.feature_values.items():
            want[r.claim_id, f] = v, r.feature_contributions[f]
    got = {(r.claim_id, r.feature): (r.value, r.contribution) for r in q_explain.q_explain_claims_map(spark, "").collect()}
    assert got == want


def test_colocated_tables_are_written_from_one_copy(spark, claims_of, monkeypatch):
    monkeypatch.setattr(q_layout, "claims", lambda s, d: claims_of(*ROWS))
    stored = seen(monkeypatch, CO, "write_colocated")
    assert catalog.QUERIES["join_predictions_colocated"](spark, "").count() == 30
    assert stored == [True, True]


def test_split_gains_carry_bins_only(spark, claims_of, monkeypatch):
    monkeypatch.setattr(q_train, "claims", lambda s, d: claims_of(*ROWS))
    columns, fn = [], TR.stratified_folds
    monkeypatch.setattr(TR, "stratified_folds", lambda df, *a, **more: columns.append(df.dtypes) or fn(df, *a, **more))
    assert catalog.QUERIES["boost_split_gains"](spark, "").count() > 0
    assert columns == [[("claim_id", "string"), ("is_denied", "int"), ("node", "int"), ("bins", "array<tinyint>")]]


def test_folds_come_from_stored_features(spark, claims_of, monkeypatch):
    monkeypatch.setattr(q_train, "claims", lambda s, d: claims_of(*ROWS))
    stored = seen(monkeypatch, TR, "stratified_folds")
    mi = q_train._folds(spark, "")
    assert stored == [True] and mi.inputFiles() and {r.fold for r in mi.collect()} == set(range(5))


def test_requests_are_written_compressed(spark, claims_of, monkeypatch, tmp_path):
    monkeypatch.setattr(q_io, "claims", lambda s, d: claims_of(*ROWS))
    monkeypatch.setattr(q_io, "_scratch", lambda s, name: str(tmp_path / name))
    got = catalog.QUERIES["scan_requests_json"](spark, "")
    assert got.count() == 30 and all(f.endswith(".json.gz") for f in spark.read.text(str(tmp_path / "requests_json")).inputFiles())


def test_training_input_is_the_model_input(spark, claims_of):
    """Features before or after the rates' join: the same rows, also of claims
    without a provider, a date or an id."""
    odd = [{"provider_npi": None}, {"service_date": None}, {"claim_id": None}, {"billed_amount": None}, {"is_denied": None}]
    claims = claims_of(*ROWS, *ROWS[:3], *odd, *[{"service_date": dt.date(2024, 3, d), "is_denied": d % 2} for d in range(1, 9)])
    keep = ("claim_id", "is_denied", "allowed_amount", "billed_amount")
    want = FE.model_input(FE.features_wide(claims, "rolling_90d"), keep)
    got = FE.training_input(claims, keep)
    assert got.dtypes == want.dtypes and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert FE.training_input(claims, ("is_denied",)).columns == ["is_denied", *FEATURE_COLUMNS]


def test_folds_deal_the_rows_out_once(spark, claims_of, tmp_path):
    stored = files.materialize(FE.training_input(claims_of(*ROWS)), str(tmp_path / "mi"))
    plan = TR.stratified_folds(stored, written=True).select("is_denied", "member_age", "fold")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("md5") < plan.index("Exchange hashpartitioning")  # what they are ordered by is made behind it


def test_written_tables_leave_no_shuffle_files(spark, claims_of, tmp_path):
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    frame = claims_of(*ROWS).repartition(3)
    was = spark.conf.get(session.SHUFFLE_CLEANUP)
    before = tracker.shuffleStatuses().size()
    got = files.materialize_alone(frame, str(tmp_path / "t"))
    assert tracker.shuffleStatuses().size() <= before and spark.conf.get(session.SHUFFLE_CLEANUP) == was
    assert got.count() == 30 and frame.count() == 30


@pytest.mark.parametrize("query, kept", [("train_lr", ["is_denied"]), ("score_model_batch", ["claim_id", "is_denied", "allowed_amount", "billed_amount"])])
def test_linear_fits_store_their_columns_once(spark, claims_of, monkeypatch, query, kept):
    monkeypatch.setattr(q_train, "claims", lambda s, d: claims_of(*ROWS))
    seen_by, fn = [], TR.fit
    monkeypatch.setattr(TR, "fit", lambda mi, *a, **more: seen_by.append((bool(mi.inputFiles()), mi.columns)) or fn(mi, *a, **more))
    monkeypatch.setattr(TR, "training_frame", None)  # no second copy
    assert catalog.QUERIES[query](spark, "").count() == (30 if query == "score_model_batch" else 23)
    assert seen_by == [(True, [*kept, *FEATURE_COLUMNS])]
