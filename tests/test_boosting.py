import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from denialscope.operators import boosting as B
from denialscope.operators import training as TR
from denialscope.sources.schema import FEATURE_COLUMNS

NAMES = ["a", "b", "c"]


def data(n=500, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(0, 2, n), rng.integers(0, 30, n)]).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - 4) * 0.6 + x[:, 1] * (x[:, 2] > 12) * 2))).astype(int)
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, *map(float, r), int(t), i % 5) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, is_denied int, fold int").repartition(parts)


def gain_of(g, h, left, lam):
    s = lambda m: g[m].sum() ** 2 / (h[m].sum() + lam)
    return (s(left) + s(~left) - g.sum() ** 2 / (h.sum() + lam)) / 2


def best(x, g, h, p):
    """(gain, feature, threshold) of a node's best split, over all values."""
    found = (0.0, None, None)
    for f in range(x.shape[1]):
        for t in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= t
            if min(h[left].sum(), h[~left].sum()) >= p.min_child_weight and min(left.sum(), (~left).sum()) >= p.min_child_rows:
                v = gain_of(g, h, left, p.reg_lambda)
                if v > found[0] + 1e-7:
                    found = (v, f, t)
    return found


def by_hand(x, y, p, pos_weight):
    """Margins after ``p.rounds`` trees, grown one leaf at a time."""
    w = np.where(y == 1, pos_weight, 1.0)
    m = np.zeros(len(y))
    sizes = []
    for _ in range(p.rounds):
        q = 1 / (1 + np.exp(-m))
        g, h = w * (q - y), w * q * (1 - q)
        leaves = [(np.arange(len(y)), 0)]
        heap = []
        def offer(k):
            rows, depth = leaves[k]
            if depth < p.depth:
                v, f, t = best(x[rows], g[rows], h[rows], p)
                if f is not None:
                    heapq.heappush(heap, (-v, k, f, t))
        offer(0)
        done = set()
        n = 1
        while heap and (p.leaves is None or n < p.leaves):
            _, k, f, t = heapq.heappop(heap)
            rows, depth = leaves[k]
            done.add(k)
            for side in (rows[x[rows, f] <= t], rows[x[rows, f] > t]):
                leaves.append((side, depth + 1))
                offer(len(leaves) - 1)
            n += 1
        for k, (rows, _) in enumerate(leaves):
            if k not in done:
                m[rows] -= p.rate * g[rows].sum() / (h[rows].sum() + p.reg_lambda)
        sizes.append(n)
    return m, sizes


@pytest.mark.parametrize("p", [
    B.Params(rounds=3, depth=3, rate=0.3, rows=1.0, columns=1.0, bins=64),
    B.Params(rounds=3, depth=6, leaves=7, rate=0.3, rows=1.0, columns=1.0, bins=64, reg_lambda=0.0, min_child_weight=1e-3, min_child_rows=5),
])
def test_against_a_model_grown_by_hand(spark, p):
    x, y = data()
    df = frame(spark, x, y)
    model, left_out = B.boost(df, NAMES, [B.Fit(p, pos_weight=2.0), B.Fit(p, fold=1, pos_weight=2.0)], fold="fold")
    want, sizes = by_hand(x, y, p, 2.0)
    assert np.allclose(model.margins(x), want, atol=1e-4)
    assert [int((t[0] < 0).sum()) for t in model.trees] == sizes
    if p.leaves:
        assert max(sizes) == p.leaves
    other = np.arange(len(y)) % 5 != 1
    part, _ = by_hand(x[other], y[other], p, 2.0)
    assert np.allclose(left_out.margins(x[other]), part, atol=1e-4)


def test_one_stage_passes_equal_shuffled_ones(spark, monkeypatch):
    x, y = data()
    df = frame(spark, x, y)
    p = B.Params(rounds=3, depth=3, bins=32)
    q = B.Params(rounds=3, depth=4, leaves=5, bins=32, min_child_rows=5)
    fits = [B.Fit(p, pos_weight=2.0), B.Fit(q, fold=1)]
    direct = B.boost(df, NAMES, fits, fold="fold")
    monkeypatch.setattr(B, "DIRECT_BYTES", B.DIRECT_BYTES * 0)
    for a, b in zip(direct, B.boost(df, NAMES, fits, fold="fold")):
        assert np.allclose(a.margins(x), b.margins(x), atol=1e-9)


def test_features_of_few_bins_share_a_column():
    """Common columns are counted once; each feature's sums and the routes are
    those of its own bins."""
    rng = np.random.default_rng(6)
    sizes = [3, 60, 2, 3, 256, 5, 3, 2]
    bins = np.column_stack([rng.integers(0, s, 4000) for s in sizes]).astype(np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    columns = B.packed(bins, starts)
    assert len(columns) == 3 and sorted(f for c in B.packing(starts) for f, _, _ in c) == list(range(8))
    tree = B.Tree()
    for node, f, cut in ((0, 1, 30), (1, 5, 2), (2, 0, 0), (4, 4, 200)):
        tree.split(node, f, cut, 1.0, 0.0, 0.0)
    at = np.zeros(4000, int)
    for k in range(4000):
        while tree.feature[at[k]] >= 0:
            at[k] = tree.child[at[k]] + (bins[k, tree.feature[at[k]]] > tree.cut[at[k]])
    assert np.array_equal(B.routed(B.steps(tree.arrays(), starts), columns, np.arange(4000)), at)
    y = rng.integers(0, 2, 4000).astype(np.float32)
    block = {"y": y, "fold": np.zeros(4000, np.int8), "margin": rng.normal(size=(1, 4000)).astype(np.float32), "columns64": columns}
    fit = B.Fit(B.Params(rows=1.0, min_child_rows=2), pos_weight=3.0)
    nodes, usable = sorted(set(at.tolist())), np.array([0, 1, 3, 4, 5, 7])
    (_, sums), = B.level_sums(0, block, [fit], {64: starts}, 0, [tree.arrays()], [nodes], [usable])
    g, h = B.gradients(fit, y, block["margin"][0])
    cells = B.layout(starts, usable)
    for j, node in enumerate(nodes):
        for i, f in enumerate(usable):
            for k, w in enumerate((g, h, np.ones(4000))):
                want = np.bincount(bins[at == node, f], weights=w[at == node], minlength=sizes[f])
                assert np.allclose(sums[j, k, cells[i]:cells[i + 1]], want, rtol=1e-5, atol=1e-4)


def test_fewer_fits_side_by_side_of_large_tables():
    assert [TR.side_by_side(n, 12) for n in (0, 600_000, 6_000_000, 36_000_000)] == [5, 5, 2, 1]


def test_reach_of_leaf_wise_growth():
    """Growing only what is within reach gives the leaves of the whole tree."""
    rng = np.random.default_rng(0)
    for _ in range(30):
        whole, cut = B.Tree(), B.Tree()
        gains = rng.exponential(size=600)
        place = {0: 0}  # node of the cut tree -> node of the whole one
        level = [0]
        for _ in range(6):
            for k in level:
                whole.split(k, 0, 0, gains[k], 0.0, 0.0)
            level = [c for k in level for c in (whole.child[k], whole.child[k] + 1)]
        level = [0]
        for _ in range(6):
            for k in level:
                cut.split(k, 0, 0, gains[place[k]], 0.0, 0.0)
                for j in (0, 1):
                    place[cut.child[k] + j] = whole.child[place[k]] + j
            reach = cut.within_reach(9)
            level = [c for k in level if k in reach for c in (cut.child[k], cut.child[k] + 1)]
        a, b = whole.best_first(9), cut.best_first(9)
        assert (a.feature, a.gain, a.child) == (b.feature, b.gain, b.child) and a.feature.count(-1) == 9


def test_model_scores_nulls_and_survives_storage(spark, tmp_path):
    x, y = data(200)
    df = frame(spark, x, y).withColumn("a", F.when(F.col("id") % 7 > 0, F.col("a"))).withColumn("b", F.when(F.col("id") % 5 > 0, F.col("b")).otherwise(float("nan")))
    model = B.boost(df, NAMES, [B.Fit(B.Params(rounds=4, depth=3))])[0]
    model.save(spark, str(tmp_path / "m"))
    again = TR.load_model(spark, str(tmp_path / "m"))
    assert again.params == model.params and again.features == NAMES
    got = model.transform(df, "p").join(again.transform(df, "q").select("id", "q"), "id").collect()
    assert len(got) == 200 and all(r.p == r.q and 0 < r.p < 1 for r in got)
    assert math.isclose(sum(v for _, v in model.importances()), 1.0)
    assert again.transform(df.limit(0), "p").count() == 0


def test_few_rows_and_one_class(spark):
    df = frame(spark, *data(6))
    assert len(B.boost(df, NAMES, [B.Fit(B.Params(rounds=2))])[0].trees) == 2
    same = B.boost(df.withColumn("is_denied", F.lit(1)), NAMES, [B.Fit(B.Params(rounds=2, rows=1.0, min_child_weight=0.0, reg_lambda=0.0))])[0]
    assert all(r.p > 0.5 for r in same.transform(df, "p").collect())
    assert B.boost(df.limit(0), NAMES, [B.Fit(B.Params(rounds=1))])[0].transform(df, "p").first().p == 0.5


def test_drawn_rows_repeat_and_columns_are_dropped(spark):
    x, y = data()
    df = frame(spark, x, y)
    p = B.Params(rounds=6, depth=2, rows=0.5, columns=0.34)
    one, two = B.boost(df, NAMES, [B.Fit(p), B.Fit(p)])
    again = B.boost(df, NAMES, [B.Fit(p)])[0]
    assert np.array_equal(one.margins(x), again.margins(x))
    assert not np.array_equal(one.margins(x), two.margins(x))
    assert all(len(set(t[0][t[0] >= 0])) <= 1 for t in one.trees)


def test_gains_as_a_query_and_as_a_pass(spark):
    x, y = data(300)
    df = frame(spark, x, y)
    edges = B.Binning([np.arange(30.0)] * 3)
    bins = {n: F.col(n).cast("int") for n in NAMES}
    g, h = F.when(F.col("is_denied") == 1, -0.5).otherwise(0.5), F.lit(0.25)
    want = B.split_gains(df, bins, g, h).orderBy(F.desc("gain")).first()
    block = {"y": y.astype(np.float32), "fold": np.zeros(300, np.int8), "margin": np.zeros((1, 300)), 64: edges.bins(x)}
    fit = B.Fit(B.Params(rows=1.0, columns=1.0))
    (_, sums), = B.level_sums(0, block, [fit], {64: edges.starts}, 0, [B.Tree().arrays()], [[0]], [np.arange(3)])
    gain, cell, *_ = B.best_splits(sums.astype(float), edges.starts, fit.params)
    assert gain[0] == pytest.approx(want.gain) and NAMES[cell[0] // 31] == want.feature and cell[0] % 31 == want.bin


def test_cross_validation_shares_one_run(spark):
    rng = np.random.default_rng(2)
    rows = [(f"c{i}", *[float(v) for v in rng.integers(0, 5, len(FEATURE_COLUMNS))], int(rng.random() < 0.4)) for i in range(300)]
    schema = "claim_id string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", is_denied int"
    mi = TR.training_frame(TR.stratified_folds(spark.createDataFrame(rows, schema)))
    config = TR.MODEL_CONFIGS["BoostedTrees"] | {"rounds": 3, "depth": 3}
    got = TR.cross_validate(mi, config, "m")
    assert len(got) == 25 and all(0 <= v <= 1 for *_, v in got)


def test_all_candidates_in_one_run_and_again(spark, tmp_path):
    """Boosted candidates beside a linear one: every fit stored, the winner
    loads, and a second run of the same store fits nothing."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        x = rng.integers(0, 5, len(FEATURE_COLUMNS)).astype(float)
        rows.append((f"c{i}", *x.tolist(), int(rng.random() < (0.8 if x[0] > 2 else 0.2))))
    mi = spark.createDataFrame(rows, "claim_id string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", is_denied int")
    small = {"rounds": 4, "depth": 3}
    configs = {"LogisticRegression": TR.MODEL_CONFIGS["LogisticRegression"], "BoostedTrees": TR.MODEL_CONFIGS["BoostedTrees"] | small,
               "BoostedTreesFast": TR.MODEL_CONFIGS["BoostedTreesFast"] | small | {"leaves": 4}}
    store = str(tmp_path / "store")
    one = TR.train_all_models(mi, configs=configs, store=store, save_path=str(tmp_path / "best"))
    assert one["metrics"].count() == 3 * 5 * 5 and one["importance"].count() == 3 * len(FEATURE_COLUMNS) and one["best_auc"] > 0.7
    assert TR.score(TR.load_model(spark, str(tmp_path / "best")), mi).where("p_denial between 0 and 1").count() == 400
    two = TR.train_all_models(mi, configs=configs, store=store)
    assert {r.stored_fits for r in two["timing"].collect()} == {5} and two["best_model"] == one["best_model"]
