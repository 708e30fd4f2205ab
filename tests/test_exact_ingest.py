import datetime as dt


from denialscope.streaming import jobs as J

from conftest import claim_rows


def land(df, source):
    df.write.mode("append").parquet(source)


def test_late_repeats_are_left_out_and_restarts_go_on(spark, tmp_path):
    base = str(tmp_path)
    first = claim_rows(spark, *[{"claim_id": f"c{i}", "service_date": dt.date(2020, 1, 1)} for i in range(40)])
    land(first.unionByName(first.limit(3)), f"{base}/src")
    run = lambda: J.stream_ingest_exact(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt", max_files=2)
    assert run().count() == 40
    later = claim_rows(spark, *[{"claim_id": f"c{i}", "service_date": dt.date(2024, 1, 1)} for i in range(30, 60)],
                       {"claim_id": None}, {"claim_id": None})
    land(later, f"{base}/src")
    got = run()
    assert got.count() == 62 and got.select("claim_id").distinct().count() == 61
    assert got.where("claim_id = 'c35'").first().service_date == dt.date(2020, 1, 1)
    assert run().count() == 62  # nothing new


def test_a_replayed_batch_replaces_what_it_wrote(spark, tmp_path):
    out = str(tmp_path)
    one = claim_rows(spark, *[{"claim_id": f"c{i}"} for i in range(10)])
    two = claim_rows(spark, *[{"claim_id": f"c{i}"} for i in range(5, 15)])
    for batch, k in ((one, 0), (two, 1), (two, 1)):
        J.ingest_microbatch(batch, k, out)
    got = spark.read.parquet(f"{out}/claims")
    assert got.count() == 15 and got.where("batch_id = 1").count() == 5


def test_streams_keep_their_state_on_disk(spark, tmp_path):
    import glob
    import json
    base = str(tmp_path)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    land(claim_rows(spark, *[{"claim_id": f"c{i % 7}"} for i in range(20)]), f"{base}/src")
    got = J.stream_ingest(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    assert got.count() == 7
    land(claim_rows(spark, *[{"claim_id": f"c{i}"} for i in range(5, 12)]), f"{base}/src")
    assert J.stream_ingest(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt").count() == 12  # a restart with its state
    said = [json.loads(line) for f in glob.glob(f"{base}/ckpt/offsets/0") for line in open(f).read().splitlines()[1:2]]
    assert "RocksDB" in said[0]["conf"]["spark.sql.streaming.stateStore.providerClass"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
