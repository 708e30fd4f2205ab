import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from denialscope.llm import sharding as S


def check(rows, shards, n, slack):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert len(rows) == n and set(by) <= set(range(shards))
    for s, rs in by.items():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    total = sum(r.size for r in rows)
    largest = max(r.size for r in rows)
    for s in range(shards):
        assert abs(sum(r.size for r in by[s]) - total / shards) <= max(slack * total / shards, largest)


@pytest.mark.parametrize("seed", [1, 2])
def test_even_bytes_with_hot_key(spark, seed):
    """A key with a third of the rows, heavy records, repeated rows."""
    rng = random.Random(seed)
    rows = [(i, 7 if i % 3 == 0 else rng.getrandbits(40), rng.choice([16, 20, 50, 900, 30_000 if i % 50 == 0 else 60])) for i in range(4000)]
    rows += [rows[0]] * 300
    df = spark.createDataFrame(rows, "doc_id long, key long, size long")
    check(S.assign_shards(df, "key", "doc_id", "size", shards=10).collect(), 10, len(rows), 0.02)


@pytest.fixture
def many_parts(spark):
    """Ranges that lie over several partitions."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    old = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("23", "false")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def test_parts_number_without_gaps(spark, many_parts):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(5).alias("key"), F.lit(16).alias("size"), F.lit(3).alias("k"), F.lit("x").alias("shard"), F.lit(0).alias("n"))
    check(S.assign_shards(df, "key", "doc_id", "size", shards=4).collect(), 4, 3000, 0.02)


@pytest.mark.parametrize("text_ids", [False, True])
def test_rows_of_a_key_adjoin_over_many_parts(spark, many_parts, text_ids):
    """As many runs of equal keys as keys, and one more for every range that a
    key goes over; ids and keys of another type too."""
    rng = random.Random(5)
    rows = [(i, rng.randrange(400), rng.randint(16, 40)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, key long, size long")
    if text_ids:
        df = df.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), F.concat(F.lit("k"), "key").alias("key"), "size")
    got = S.assign_shards(df, "key", "doc_id", "size", shards=4, pieces=4).collect()
    check(got, 4, 4000, 0.05)
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.shard, r.slot)):
        by[r.shard].append(r.key)
    runs = sum(1 + sum(a != b for a, b in zip(ks, ks[1:])) for ks in by.values())
    assert runs <= 400 + 4 * 4 * 3


def test_groups_stay_together_where_they_fit(spark):
    rng = random.Random(3)
    rows = [(i, i // 4 * 1000003 % (1 << 40), rng.randint(16, 200)) for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, key long, size long")
    got = S.assign_shards(df, "key", "doc_id", "size", shards=8).collect()
    homes = defaultdict(set)
    for r in got:
        homes[r.key].add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) < 0.15 * len(homes)


def test_nulls_empty_few(spark):
    df = spark.createDataFrame([(None, None, None), (1, 2, 16), (1, 2, 16)], "doc_id long, key long, size long")
    got = S.assign_shards(df, "key", "doc_id", "size").collect()
    assert len(got) == 3 and all(r.shard is not None and r.slot is not None for r in got)
    assert S.assign_shards(df.limit(0), "key", "doc_id", "size").count() == 0
    zero = S.assign_shards(df.withColumn("size", F.lit(0)), "key", "doc_id", "size").collect()
    assert len(zero) == 3


def test_written_shards(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("key"), (F.col("id") % 50 + 16).alias("size"), F.lit("text").alias("text"))
    S.write_shards(df, str(tmp_path / "out"), "key", "doc_id", "size", shards=5)
    back = spark.read.parquet(str(tmp_path / "out"))
    check(back.collect(), 5, 500, 0.1)
    assert set(back.columns) == {"doc_id", "key", "size", "text", "shard", "slot"}
