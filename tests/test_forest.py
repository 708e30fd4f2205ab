import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from denialscope.operators import boosting as B
from denialscope.operators import forest as FO
from denialscope.operators import metrics as M
from denialscope.operators import training as TR
from denialscope.sources.schema import FEATURE_COLUMNS

NAMES = ["a", "b", "c", "d"]


def data(n=900, seed=5):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(0, 2, n), rng.integers(0, 30, n), rng.normal(size=n).round(1)]).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - 4) + x[:, 1] * (x[:, 2] > 12) * 2))).astype(int)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, c double, d double, is_denied int")


def gini(c, w):
    c = c * np.array(w)
    return c.sum() * (1 - ((c / c.sum()) ** 2).sum()) if c.sum() else 0.0


def test_levels_against_splits_by_hand():
    """Sums and splits of each open node are those of its drawn rows."""
    x, y = data()
    table = B.Binning([np.unique(x[:, k])[:-1] for k in range(4)])
    bins, sizes = table.bins(x), np.diff(table.starts)
    values = np.ascontiguousarray((2 * bins + y[:, None]).T.astype(np.uint8))
    p, w = FO.Params(trees=1, depth=4, min_rows=7), (0.8, 1.5)
    times = FO.drawn(p, 0, 3, len(y))
    tree, nodes, at = FO.Tree.leaves(np.zeros((1, 2))), np.array([0]), np.zeros(len(y), int)
    for level in range(p.depth):
        sub = FO.seen_features(p, 0, level, len(nodes), 4)
        (_, sums), = FO.level_sums(3, values, p, sizes, level, {0: tree}, {0: nodes})
        got = FO.best(sums, sub, sizes, p, w)
        classes = lambda rows: np.array([times[rows & (y == k)].sum() for k in (0, 1)], float)
        for j, node in enumerate(nodes):
            here = at == node
            want = 0.0
            for f in sub[j]:
                for cut in range(sizes[f]):
                    left, right = classes(here & (bins[:, f] <= cut)), classes(here & (bins[:, f] > cut))
                    if min(left.sum(), right.sum()) >= p.min_rows:
                        want = max(want, gini(left + right, w) - gini(left, w) - gini(right, w))
            assert got[j, 0] == pytest.approx(want, abs=1e-8) and np.array_equal(got[j, 5:], classes(here))
        old = tree
        tree, nodes = tree.grown(nodes, got)
        for k in range(len(y)):
            if tree.feature[at[k]] >= 0 and at[k] < len(old.feature):
                at[k] = tree.child[at[k]] + (bins[k, tree.feature[at[k]]] > tree.cut[at[k]])
    leaves = tree.feature < 0
    assert len(tree.feature) > 9 and tree.counts[1:].sum(axis=1).min() >= p.min_rows and tree.counts[leaves].sum() == times.sum()
    small = tree.pruned(w)
    reach = lambda t: FO.reached(t.feature, 2 * t.cut.astype(np.int16) + 1, t.child, p.depth, values, np.arange(len(y)))
    vote = lambda t: (t.counts * np.array(w))[reach(t)].argmax(axis=1)
    assert len(small.feature) < len(tree.feature) and np.array_equal(vote(small), vote(tree))
    for k in np.flatnonzero(small.feature >= 0):
        a, b = small.child[k], small.child[k] + 1
        assert small.feature[a] >= 0 or small.feature[b] >= 0 or (small.counts[a] * w).argmax() != (small.counts[b] * w).argmax()


def test_forest_learns_and_passes_may_be_cut(spark, monkeypatch):
    x, y = data()
    df = frame(spark, x, y)
    p = FO.Params(trees=20, depth=5)
    model = FO.forest(df, NAMES, p, (1.0, 1.0))
    scored = TR.score(PipelineModel([model]), df.select("*", *[F.lit(0.0).alias(c) for c in FEATURE_COLUMNS]))
    assert M.auc(scored).first()[0] > 0.85
    shares = model.featureImportances.toArray()
    assert shares.sum() == pytest.approx(1.0) and shares.argmax() == 0 and shares.min() >= 0
    monkeypatch.setattr(FO, "PASS_BYTES", 1)
    again = FO.forest(df, NAMES, p, (1.0, 1.0))
    assert np.array_equal(again.probabilities()(x), model.probabilities()(x))


def test_counts_of_draws_are_poisson():
    times = FO.drawn(FO.Params(), 1, 0, 200_000)
    assert abs(times.mean() - 1) < 0.01 and abs((times == 0).mean() - np.exp(-1)) < 0.005
    assert np.array_equal(times, FO.drawn(FO.Params(), 1, 0, 200_000)) and not np.array_equal(times, FO.drawn(FO.Params(), 2, 0, 200_000))


def test_few_rows_one_class_and_nulls(spark):
    x, y = data(60)
    df = frame(spark, x, y)
    p = FO.Params(trees=3, depth=3)
    for odd in (df.limit(0), df.where("is_denied = 1"), df.limit(5), df.withColumn("a", F.lit(None).cast("double")).withColumn("d", F.lit(float("nan")))):
        model = FO.forest(odd, NAMES, p, (1.0, 1.0))
        got = model.transform(df).select("prediction").collect()
        assert len(model.trees) == 3 and len(got) == 60
    assert FO.forest(df.where("is_denied = 1"), NAMES, p, (1.0, 1.0)).probabilities()(x).min() == 1.0


def test_fitted_forest_is_a_stage_that_survives_storage(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(f"c{i}", *[float(v) for v in rng.integers(0, 5, len(FEATURE_COLUMNS))], int(rng.random() < 0.4)) for i in range(300)]
    mi = spark.createDataFrame(rows, "claim_id string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", is_denied int")
    model = TR.fit(mi, {"kind": "rf", "numTrees": 6, "maxDepth": 4, "minInstancesPerNode": 10, "weights": "balanced"})
    assert isinstance(model.stages[-1], FO.ForestModel)
    TR.save_model(spark, model, str(tmp_path / "m"))
    again = TR.load_model(spark, str(tmp_path / "m"))
    got = TR.score(model, mi).join(TR.score(again, mi).select("claim_id", F.col("p_denial").alias("q")), "claim_id").collect()
    assert len(got) == 300 and all(r.p_denial == r.q and r.predicted == int(r.p_denial > 0.5) for r in got)
    assert TR.feature_importance(again) == TR.feature_importance(model)
