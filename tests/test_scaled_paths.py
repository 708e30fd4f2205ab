"""Steps that large tables share: mapping in compiled methods, provider stats
sized before the join, claims scored once a micro-batch, one shuffle to ingest."""

import uuid

import pytest
from conftest import SF001, claim_rows
from pyspark.sql import functions as F

from denialscope.operators import history as H
from denialscope.operators import scoring as SC
from denialscope.plans.daily import daily_scoring
from denialscope.session import METHOD_LIMIT, scratch_path
from denialscope.sources.fixtures import claims
from denialscope.streaming import jobs as J


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def test_the_claims_mapping_runs_in_methods_that_are_compiled(spark):
    spark.conf.unset(METHOD_LIMIT)
    claims(spark, SF001)
    assert int(spark.conf.get(METHOD_LIMIT)) <= 8000


def test_loo_rates_need_no_shuffle_of_the_claims_when_stats_are_small(spark):
    rows = claim_rows(spark, {"is_denied": 1}, {}, {"provider_npi": None}, {"provider_npi": "1000000009"})
    out = H.with_loo_rate(rows)
    assert "hashpartitioning" not in _plan(out)
    assert {r.claim_id: r[H.RATE] for r in out.collect()} == {"T-0": 0.0, "T-1": 1.0, "T-2": 0.25, "T-3": 0.25}


class CountingScorer(SC.RuleScorer):
    def __init__(self, seen):
        self.seen = seen

    def score(self, features):
        seen = self.seen

        def count(p):
            seen.add(1)
            return p
        return super().score(features).withColumn(SC.P, F.udf(count, "double")(SC.P))


def test_a_microbatch_is_scored_once_and_its_summary_counts_what_is_stored(spark):
    base = scratch_path(spark, f"t/{uuid.uuid4().hex}")
    batch = claim_rows(spark, {}, {"submission_date": None, "billed_amount": 60000.0}, {"provider_npi": "bad"})
    rates = H.history_rates(claim_rows(spark, {"is_denied": 1}, {}))
    seen = spark.sparkContext.accumulator(0)
    J.score_microbatch(batch, 3, rates, base, CountingScorer(seen))
    preds = J.read_batches(spark, base, "predictions")
    assert preds.count() == 2 and seen.value == 2
    s = J.read_batches(spark, base, "batch_summary").collect()
    assert [(r.batch_id, r.total_claims, r.total_predicted_denied) for r in s] == [(3, 2, preds.where("predicted_denied").count())]


def test_a_microbatch_without_valid_claims_has_an_empty_summary(spark):
    base = scratch_path(spark, f"t/{uuid.uuid4().hex}")
    J.score_microbatch(claim_rows(spark, {"provider_npi": "bad"}), 0, H.history_rates(claim_rows(spark, {})), base)
    s = J.read_batches(spark, base, "batch_summary").first()
    assert (s.total_claims, s.total_predicted_denied, s.batch_denial_rate) == (0, 0, 0.0)


def test_repeats_and_known_ids_leave_by_one_shuffle_of_the_claims(spark, no_broadcast):
    batch = claim_rows(spark, {}, {"claim_id": "T-0"}, {"claim_id": "old"}, {"claim_id": None}, {"claim_id": "new"})
    known = spark.createDataFrame([("old",), ("gone",)], "claim_id STRING")
    out = J.fresh_claims(batch, known)
    assert sorted(r.claim_id for r in out.collect()) == ["T-0", "new"]
    assert out.columns == batch.columns
    assert _plan(J.fresh_claims(batch, known)).count("hashpartitioning") == 2  # claims and known ids


def test_the_baseline_reads_its_training_claims_as_their_own_history(spark, monkeypatch):
    asked = []
    whole = H._rate_of_days
    monkeypatch.setattr(H, "_rate_of_days", lambda *a: asked.append(1) or whole(*a))
    rows = claim_rows(spark, {"is_denied": 1}, {}, {"provider_npi": None}, {"service_date": None})
    daily_scoring(rows, "2024-03-30", "2024-03-01", scratch_path(spark, f"t/{uuid.uuid4().hex}"))
    assert len(asked) == 1  # the batch's rates; the training side is a plain window
    names = ["claim_id", H.RATE]
    mixed = claim_rows(spark, {"is_denied": 1}, {"is_denied": None}, {"service_date": None}, {"provider_npi": None}, {"provider_npi": "1000000009", "is_denied": None})
    mixed = mixed.unionByName(mixed.withColumn("service_date", F.date_add("service_date", 30)))
    a, b = H.with_rolling_rate(mixed).select(names), H.with_rolling_history(mixed, H.RollingHistory(mixed)).select(names)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
