import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from denialscope.operators import baseline as BL
from denialscope.operators import drift as DR
from denialscope.operators import history as H
from denialscope.plans.daily import daily_scoring

from conftest import claim_rows


def some_claims(spark, n=300, seed=1):
    rng = random.Random(seed)
    return claim_rows(spark, *[{"provider_npi": rng.choice([None, "1", "2", "2", "2", "3"]), "is_denied": rng.choice([0, 1, None]),
                                "service_date": None if rng.random() < 0.05 else dt.date(2023, 1, 1) + dt.timedelta(days=rng.randrange(400)),
                                "submission_date": rng.choice([None, dt.date(2024, 3, 1) + dt.timedelta(days=rng.randrange(60))]),
                                "billed_amount": rng.choice([0.0, 10.0, 100.5, 7e4])} for _ in range(n)])


def rates(df):
    return sorted((r.claim_id, round(r[H.RATE], 12)) for r in df.select("claim_id", H.RATE).collect())


def test_provider_days_equal_the_whole_history(spark, tmp_path):
    claims = some_claims(spark)
    early = F.coalesce(F.col("submission_date") < dt.date(2024, 4, 1), F.lit(True))
    path = str(tmp_path / "days")
    H.add_days(claims.where(early), path, "base")
    H.add_days(claims.where(~early), path, "2024-05-01")
    H.add_days(claims.where(~early), path, "2024-05-01")  # the same run again
    batch = claims.where(~early)
    assert rates(H.with_stored_days(batch, H.StoredDays(path))) == rates(H.with_rolling_history(batch, H.RollingHistory(claims)))


def test_only_the_months_of_the_window_are_read(spark, tmp_path):
    claims = some_claims(spark, 600)
    path = str(tmp_path / "days")
    H.add_days(claims, path, "base")
    first = (dt.date(2023, 11, 1) - dt.date(1970, 1, 1)).days
    got = H.stored_days(spark, path, first, first + 40)
    files = {f.split("month=")[1][:6] for f in spark.read.schema(H.DAYS_SCHEMA).option("basePath", path).parquet(path).where("month between 202311 and 202312").inputFiles()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert got.agg(F.min("day"), F.max("day")).first() and files
    assert got.count() == claims.where("provider_npi is not null and is_denied is not null").select("provider_npi", F.unix_date("service_date").alias("d")) \
        .where(F.col("d").between(first, first + 40)).distinct().count()


def test_no_dates_no_history(spark, tmp_path):
    claims = some_claims(spark, 5).withColumn("service_date", F.lit(None).cast("date"))
    assert {r for _, r in rates(H.with_stored_days(claims, H.StoredDays(str(tmp_path / "none"))))} == {0.25}


@pytest.mark.parametrize("wide", [0.5, 1.0, 3.0])
def test_stored_baseline_gives_the_same_psi(spark, tmp_path, wide):
    """Batches inside, on and beyond the training range; nulls, NaN, constants."""
    rng = random.Random(7)
    def rows(n, scale):
        return [(rng.gauss(0, scale), float(rng.randrange(3)), rng.choice([None, float("nan"), rng.random()]), 1.0, None, rng.choice([0.1, 0.2, 0.30000000000000004])) for _ in range(n)]
    names = ["a", "b", "c", "d", "e", "f"]
    schema = ", ".join(f"{c} double" for c in names)
    train, score = spark.createDataFrame(rows(3000, 1.0), schema), spark.createDataFrame(rows(400, wide), schema)
    base = BL.save_baseline(train, str(tmp_path / "b"), names)
    want = {r.feature: r.asDict() for r in DR.drift_features(train, score, names).collect()}
    got = {r.feature: r.asDict() for r in BL.drift_against(BL.load_baseline(spark, str(tmp_path / "b")), score).collect()}
    assert got.keys() == want.keys()
    for c in names:
        for k, v in want[c].items():
            assert got[c][k] == v or got[c][k] == pytest.approx(v, abs=1e-4, nan_ok=True), (c, k)
        assert got[c]["psi"] == want[c]["psi"]
    assert base.cells.count() <= len(names) * (BL.CELLS + 1)


def test_edges_open_few_cells_and_parts_add_up(spark, tmp_path):
    train = spark.range(20_000).select(((F.col("id") * 7919) % 10_007 / 10.0).alias("a"))
    base = BL.save_baseline(train, str(tmp_path / "b"), ["a"])
    edges = [0.0, 3.35, 500.0, 999.99, 2000.0]
    got = BL.counts_beyond(base, {"a": edges})
    assert [got["a", k] for k in range(5)] == [train.where(F.col("a") >= e).count() for e in edges]
    assert BL.opened_cells(base, {("a", 5)}).count() <= 10
    plan = BL.opened_cells(base, {("a", 5)})._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(cell,5)" in plan or "In(cell" in plan
    twice = BL.merged([base, base], str(tmp_path / "two"))
    assert BL.counts_beyond(twice, {"a": [500.0]})["a", 0] == 2 * got["a", 2]
    assert BL.load_baseline(spark, str(tmp_path / "none")) is None


def test_second_day_reads_neither_history_nor_training(spark, tmp_path):
    """With provider days and baseline in place the source is read for the
    batch only."""
    claims = some_claims(spark)
    out = str(tmp_path / "daily")
    one = daily_scoring(claims, "2024-05-01", "2024-04-01", out)
    fresh = claims.where("submission_date > '2024-04-10'")
    two = daily_scoring(fresh, "2024-05-02", "2024-04-10", out)  # older rows are not even there
    want = daily_scoring(claims, "2024-05-03", "2024-04-10", str(tmp_path / "whole"), history=claims.unionByName(fresh))
    p = lambda o: sorted((r.claim_id, r.denial_probability) for r in o["predictions"].collect())
    assert p(two) == p(want) and one["drift_report"].count() == 1
    assert two["drift_details"].count() == 23
