import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, claim_rows
from denialscope.operators import history as H
from denialscope.operators import sketches as K
from denialscope.sources import colocated as CO
from denialscope.sources import lookup
from denialscope.sources.fixtures import claims


def scanned(df):
    """Rows that the scan of a plan without shuffles hands on."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookups_read_the_groups_of_their_id_only(spark, tmp_path):
    c = claims(spark, SF001)
    n, path = c.count(), str(tmp_path / "t")
    lookup.write_lookup(c.unionByName(claim_rows(spark, {"claim_id": None}, {"claim_id": None})), path, rows_per_file=500)
    table = lookup.read_lookup(spark, path)
    assert table.count() == n + 2
    some = [r.claim_id for r in c.select("claim_id").limit(3).collect()]
    assert sorted(r.claim_id for r in lookup.find(table, some).collect()) == sorted(some)
    assert 0 < scanned(lookup.find(table, some[:1])) <= 1500 < n
    assert lookup.find(table, ["none"]).count() == 0 and lookup.find(table, []).count() == 0


def test_bloom_filters_rule_out_ids_within_a_files_range(spark, tmp_path):
    path, plain = str(tmp_path / "t"), str(tmp_path / "p")
    c = claims(spark, SF001)
    lookup.write_lookup(c, path, rows_per_file=10**6)
    absent = c.agg(F.min("claim_id")).first()[0] + "0"
    assert scanned(lookup.find(lookup.read_lookup(spark, path), [absent])) == 0
    c.coalesce(1).write.parquet(plain)
    assert scanned(lookup.find(lookup.read_lookup(spark, plain), [absent])) > 0


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def bucketed(df, name, tmp_path, key, buckets=4, like=None):
    return CO.write_colocated(df, name, str(tmp_path / name), key, buckets, like)


def test_colocated_joins_do_not_shuffle_and_hot_keys_stay_apart(spark, tmp_path, monkeypatch):
    base = [{"claim_id": f"c{i}", "provider_npi": None if i % 10 == 0 else "hot" if i % 3 else f"p{i}", "is_denied": i % 2} for i in range(120)]
    c = claim_rows(spark, *base).select("claim_id", "provider_npi", "is_denied")
    t = bucketed(c, "colo_prov", tmp_path, "provider_npi")
    assert t.hot == ("hot",) and t.cold(spark).where("provider_npi = 'hot'").isEmpty() and t.rows(spark).count() == 120
    got = CO.join_group(spark, t, H.provider_stats)
    want = c.join(H.provider_stats(c), "provider_npi", "left")
    key = lambda df: sorted(map(str, df.select("claim_id", "provider_npi", "total_denied", "total_claims").collect()))
    assert key(got) == key(want)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        cold = t.cold(spark)
        assert "Exchange" not in plan(cold.join(H.provider_stats(cold), "provider_npi", "left"))
        u = bucketed(c.select("provider_npi", F.col("claim_id").alias("other")), "colo_other", tmp_path, "provider_npi", like=t)
        assert "Exchange" not in plan(t.cold(spark).join(u.cold(spark), "provider_npi"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for how in ("inner", "left"):
        a = CO.join_colocated(spark, t, u, how).count()
        assert a == c.join(c.select("provider_npi", F.col("claim_id").alias("other")), "provider_npi", how).count()


def test_colocated_tables_must_match(spark, tmp_path):
    c = claim_rows(spark, *[{"provider_npi": f"p{i}"} for i in range(20)]).select("claim_id", "provider_npi")
    a, b = bucketed(c, "colo_a", tmp_path, "provider_npi"), bucketed(c, "colo_b", tmp_path, "provider_npi", 8)
    with pytest.raises(ValueError, match="alike"):
        CO.join_colocated(spark, a, b)
    with pytest.raises(ValueError, match="inner or left"):
        CO.join_colocated(spark, a, a, "full")
    e = bucketed(c.limit(0), "colo_empty", tmp_path, "provider_npi")
    f = bucketed(c.select("provider_npi", F.col("claim_id").alias("other")), "colo_full", tmp_path, "provider_npi", like=e)
    assert e.hot == () and CO.join_colocated(spark, e, f).count() == 0
    assert CO.join_colocated(spark, f, e, "left").where("claim_id is null").count() == 20


def test_sketches_of_days_merge_within_the_bound(spark):
    c = claims(spark, SF001)
    days = K.day_sketches(c)
    got = {(r.claim_type, r.q): r for r in K.merged_quantiles(days, (0.05, 0.5, 0.95), ("claim_type",)).collect()}
    for kind, n in c.groupBy("claim_type").agg(F.count("billed_amount")).collect():
        part = c.where(F.col("claim_type") == kind)
        for q in (0.05, 0.5, 0.95):
            assert got[kind, q].n == n
            at = K.ranks(part, spark.createDataFrame([(q, got[kind, q].value)], "q DOUBLE, value DOUBLE")).first()
            assert at.below - 2 * K.rank_error() <= q <= at.at_most + 2 * K.rank_error()


def test_sketches_of_odd_values(spark):
    day = dt.date(2024, 1, 1)
    c = claim_rows(spark, *[{"billed_amount": v, "service_date": s, "claim_type": k} for v, s, k in [
        (None, day, "medical"), (float("nan"), day, "medical"), (5.0, None, None), (5.0, None, None), (float("inf"), day, "dental")]])
    days = K.day_sketches(c)
    assert sorted((str(r.day), str(r.claim_type)) for r in days.collect()) == [("2024-01-01", "dental"), ("None", "None")]
    got = {r.q: (r.value, r.n) for r in K.merged_quantiles(days).collect()}
    assert got == {0.5: (5.0, 3), 0.95: (float("inf"), 3)}
    assert K.merged_quantiles(K.day_sketches(c.limit(0))).count() == 0
    assert K.ranks(c, K.merged_quantiles(days).limit(0)).count() == 0
