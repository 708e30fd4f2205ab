import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from denialscope.llm import graph_index as G
from denialscope.llm import nearest as N
from denialscope.llm.registry import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, asks):
    """Per query row: the sorted scores and ids of all candidates."""
    ok = [(i, v) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = []
    for n, (i, v) in enumerate(ok):
        if asks(i):
            near = sorted((-float(np.dot(np.float64(v), np.float64(w))), j) for m, (j, w) in enumerate(ok) if m != n and len(w) == len(v))
            out.append((i, [(j, -s) for s, j in near[:k]]))
    return out


def recall(got, want):
    by = {}
    for r in got:
        by.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(by.get(i, set()) & {j for j, _ in near}) for i, near in want)
    return hits / sum(len(near) for _, near in want)


def as32(v):
    return [float(np.float32(c)) for c in v]


@pytest.mark.parametrize("kind", ["even", "clusters", "lengths"])
def test_recall_over_shards(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24))
    if kind == "clusters":
        x = x * 0.1 + rng.normal(size=(10, 24))[rng.integers(0, 10, 3000)]
    if kind == "lengths":
        x *= rng.lognormal(0, 0.5, size=(3000, 1))
    rows = [(i, as32(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = N.nearest_neighbours(df, F.col("vec_id") % 20 == 0, shard_rows=600).collect()
    want = brute(rows, 20, lambda i: i % 20 == 0)
    assert len(got) == 150 * 20 and recall(got, want) >= 0.95
    vec = dict(rows)
    for r in got:
        assert r.vec_id != r.query_id
        assert r.score == pytest.approx(float(np.dot(np.float64(vec[r.query_id]), np.float64(vec[r.vec_id]))), abs=1e-12)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    for near in by.values():
        near.sort()
        assert [r[0] for r in near] == list(range(1, 21)) and [r[1:] for r in near] == sorted(r[1:] for r in near)


def test_hot_vector_ties_and_bad_rows(spark):
    """A third of all rows share a vector; unusable rows; two lengths."""
    rng = random.Random(1)
    hot = as32([1.0, 0.5, 0.0, 0.0])
    rows = [(i, hot if i % 3 == 0 else as32([rng.gauss(0, 1) for _ in range(4)])) for i in range(600)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 4), (1003, [1.0, None, 0.0, 0.0]), (1004, [float("nan")] * 4), (1005, [float("inf"), 0.0, 0.0, 0.0]),
             (None, [1.0, 0.0, 0.0, 0.0]), (1020, [3.0, 4.0]), (1021, [1.0, 0.0]), (1022, [-1.0, 0.0]), (40, rows[40][1])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).withColumn("id", F.lit("x")).withColumn("score", F.lit(1)).withColumn("uid", F.lit(2))
    got = N.nearest_neighbours(df, F.col("vec_id") % 20 == 0, shard_rows=150).collect()
    want = brute(rows, 20, lambda i: i % 20 == 0)
    key = lambda r: (r[0], [(j, round(s, 9)) for j, s in r[1]])
    mine = {}
    for r in sorted(got, key=lambda r: r.rank):
        mine.setdefault((r.query_id, r.rank), []).append((r.vec_id, round(r.score, 9)))
    for i, near in map(key, want):
        for n, hit in enumerate(near):
            assert hit in mine[(i, n + 1)]
    assert len(got) == sum(len(near) for _, near in want)


def test_empty_and_no_queries(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert N.nearest_neighbours(df, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(20, [1.0], 0)], SCHEMA)
    assert N.nearest_neighbours(one, F.col("vec_id") % 20 == 0).count() == 0
    assert N.nearest_neighbours(one, F.lit(None).cast("boolean")).count() == 0


def test_every_node_is_reached_and_edges_are_diverse():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(400, 8)) * 0.01 + c for c in rng.normal(size=(4, 8))])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph, entries = G.build(x)
    assert G.reached(graph, entries).all()
    for p in range(0, len(x), 97):
        kept = graph[p][graph[p] >= 0]
        assert p not in kept and len(set(kept.tolist())) == len(kept)


def test_pruning_rule():
    """Kept in order of nearness, none that a kept one is much nearer to."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 6))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    pool = np.append(rng.permutation(80), [-1, 5, 5]).astype(np.int32)[None]
    got = [int(v) for v in G.prune(x, np.array([5]), pool, 8, 1.2)[0] if v >= 0]
    d = lambda a, b: 2 - 2 * float(x[a] @ x[b])
    want, left = [], sorted(set(range(80)) - {5}, key=lambda c: d(5, c))
    while left and len(want) < 8:
        want.append(left.pop(0))
        left = [c for c in left if 1.44 * d(want[-1], c) > d(5, c)]
    assert got == want


def test_query_on_the_small_table(spark):
    got = QUERIES["op13_graph_neighbours"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert recall(got.collect(), brute(rows, 20, lambda i: i % 20 == 0)) >= 0.99
