import json
import os

import pytest
from pyspark.sql import functions as F

from denialscope.sources import published as P


def read(spark, path, **kw):
    return sorted(tuple(r) for r in P.read_published(spark, path, "day", **kw).collect())


def rows(spark, *r, schema="x INT, day STRING"):
    return spark.createDataFrame(list(r), schema)


def test_days_are_replaced_whole_and_older_versions_stay_readable(spark, tmp_path):
    t = str(tmp_path / "t")
    with pytest.raises(ValueError, match="nothing"):
        read(spark, t)
    assert P.read_published(spark, t, "day", empty=rows(spark, (1, "a")).schema).count() == 0
    assert P.publish(rows(spark, (1, "a"), (2, "a"), (3, "b"), (3, "b"), (4, None)), t, "day") == 1
    assert read(spark, t, keys=["b"]) == [(3, "b"), (3, "b")] and read(spark, t, keys=[None]) == [(4, None)]
    assert P.publish(rows(spark, (9, "a")), t, "day") == 2
    assert P.publish(rows(spark), t, "day", ["b"]) == 3  # a day that has become empty
    assert P.publish(rows(spark), t, "day") == 3
    got = P.read_published(spark, t, "day")
    assert sorted((r.x, r.day) for r in got.collect()) == [(4, None), (9, "a")]
    assert sorted(r.x for r in P.read_published(spark, t, "day", version=1).collect()) == [1, 2, 3, 3, 4]
    assert read(spark, t, keys=["zz"]) == []


def test_a_writer_that_fails_leaves_nothing_to_readers(spark, tmp_path):
    t = str(tmp_path / "t")
    P.publish(rows(spark, (1, "a"), (2, "b")), t, "day")
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") < 99, F.col("id").cast("int"))
                                                     .otherwise(F.raise_error(F.lit("lost"))).alias("x"), F.lit("a").alias("day"))
    with pytest.raises(Exception, match="lost"):
        P.publish(broken, t, "day", ["a"])
    assert read(spark, t) == [(1, "a"), (2, "b")]
    # rows written aside whose log entry never came are not read either
    rows(spark, (7, "a")).write.partitionBy("day").parquet(f"{t}/data/pub=dead")
    assert read(spark, t) == [(1, "a"), (2, "b")]
    assert P.publish(rows(spark, (5, "a")), t, "day") == 2 and read(spark, t) == [(2, "b"), (5, "a")]


def test_the_second_writer_of_a_version_fails(spark, tmp_path, monkeypatch):
    t = str(tmp_path / "t")
    P.publish(rows(spark, (1, "a")), t, "day")
    monkeypatch.setattr(P, "_latest", lambda *_: 0)
    with pytest.raises(Exception, match="(?i)exists"):
        P.publish(rows(spark, (2, "a")), t, "day")
    monkeypatch.undo()
    assert read(spark, t) == [(1, "a")]


def test_columns_are_added_and_widened(spark, tmp_path):
    t = str(tmp_path / "t")
    P.publish(rows(spark, (1, 1.5, "a"), schema="x INT, f FLOAT, day STRING"), t, "day")
    P.publish(rows(spark, (2**40, 2.5, "new", "b"), schema="x LONG, f DOUBLE, note STRING, day STRING"), t, "day")
    P.publish(rows(spark, (3, "c")), t, "day")  # an older writer
    got = P.read_published(spark, t, "day")
    assert got.dtypes == [("x", "bigint"), ("f", "double"), ("note", "string"), ("day", "string")]
    assert sorted(tuple(r) for r in got.where("x is not null").collect()) == [(1, 1.5, None, "a"), (3, None, None, "c"), (2**40, 2.5, "new", "b")]
    before = len(os.listdir(f"{t}/data"))
    with pytest.raises(ValueError, match="column x was bigint and is now string"):
        P.publish(rows(spark, ("no", "d"), schema="x STRING, day STRING"), t, "day")
    assert len(os.listdir(f"{t}/data")) == before


def test_snapshots_bound_the_log(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "SNAPSHOT_EVERY", 3)
    t = str(tmp_path / "t")
    for i in range(7):
        P.publish(rows(spark, (i, f"d{i % 4}")), t, "day")
    assert read(spark, t) == [(3, "d3"), (4, "d0"), (5, "d1"), (6, "d2")]
    assert read(spark, t, version=5) == [(1, "d1"), (2, "d2"), (3, "d3"), (4, "d0")]
    file = [f for f in os.listdir(f"{t}/log/v=6") if f.endswith(".json")]
    assert len(file) == 1 and {json.loads(x)["key"] for x in open(f"{t}/log/v=6/{file[0]}")} == {"d0", "d1", "d2", "d3"}


def test_compaction_keeps_rows_and_lowers_files(spark, tmp_path):
    t = str(tmp_path / "t")
    many = spark.range(600, numPartitions=12).select(F.col("id").cast("int").alias("x"), F.concat(F.lit("d"), F.col("id") % 3).alias("day"))
    P.publish(many, t, "day")
    before, files = read(spark, t), P.live_files(spark, t, "day")
    P.compact(spark, t, "day", rows_per_file=300)
    assert read(spark, t) == before and files == 36 and P.live_files(spark, t, "day") <= 4


def test_odd_key_values_come_back(spark, tmp_path):
    t = str(tmp_path / "t")
    keys = ["a/b", "x=y", "50%", " ", "n", "vn", "ü", "2024-01-01 00:00:00"]
    P.publish(rows(spark, *[(i, k) for i, k in enumerate(keys)]), t, "day")
    assert read(spark, t) == [(i, k) for i, k in enumerate(keys)]
    P.publish(rows(spark, (9, "")), t, "day", [""])
    assert read(spark, t, keys=[""]) == [(9, None)]
