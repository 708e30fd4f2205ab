"""Random forests grown level by level, all trees in the same passes.

The table is binned once and kept in blocks, like ``boosting``'s. A pass sums,
for every tree and open node, the classes of the drawn rows by bin of the
features that the node may split on; a shuffle adds the sums up by (tree, group
of nodes) and the reducing tasks pick the splits, which alone come to the
driver. A forest of depth d takes d passes, more where the open nodes' sums
would exceed ``PASS_BYTES`` a block.

Rows are drawn with replacement (Poisson counts of mean 1), every node sees
√features of them, splits lower the Gini impurity of the weighted classes and
leave ``min_rows`` drawn rows on either side. A tree votes with its leaf's share
of the weighted positives; splits between leaves of one class are taken back, as
MLlib's forests do; importances are the weighted impurity decreases,
each tree's adding up to 1. The model is a stage of a ``PipelineModel``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship
from ..sources import files
from . import boosting as B

PASS_BYTES = 256 << 20  # sums of one block in one pass
NODES_A_KEY = 256
KEYS_A_REDUCER = 32
#: Poisson counts of mean 1 by a number below 65,536.
COUNTS = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(8)]), (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


@dataclass(frozen=True)
class Params:
    trees: int = 200
    depth: int = 12
    min_rows: int = 10
    bins: int = 32
    seed: int = 42


@dataclass
class Tree:
    """Node k is a leaf where ``feature[k]`` is -1; else rows whose bin is at
    most ``cut[k]`` go to ``child[k]``, the rest to the node after it."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    gain: np.ndarray
    counts: np.ndarray  # (nodes, 2): drawn rows by class

    @staticmethod
    def leaves(counts: np.ndarray) -> Tree:
        n = len(counts)
        return Tree(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n, np.int32), np.zeros(n), counts)

    def grown(self, nodes: np.ndarray, splits: np.ndarray) -> tuple[Tree, np.ndarray]:
        """The tree with ``nodes`` split (rows of ``best``), and the new nodes."""
        gain, feature, cut, left, total = splits[:, 0], splits[:, 1], splits[:, 2], splits[:, 3:5], splits[:, 5:7]
        self.counts[nodes] = total
        ok = gain > 0
        nodes, n = nodes[ok], len(self.feature)
        child = n + 2 * np.arange(len(nodes))
        self.feature[nodes], self.cut[nodes], self.child[nodes], self.gain[nodes] = feature[ok], cut[ok], child, gain[ok]
        new = Tree.leaves(np.stack([left[ok], (total - left)[ok]], axis=1).reshape(-1, 2))
        both = {k: np.concatenate([getattr(self, k), getattr(new, k)]) for k in ("feature", "cut", "child", "gain", "counts")}
        return Tree(**both), np.arange(n, n + len(new.feature))

    def pruned(self, weights: tuple[float, float]) -> Tree:
        """The tree without splits whose both sides are leaves of one class."""
        feature, child = self.feature.tolist(), self.child.tolist()
        vote = (self.counts[:, 1] * weights[1] > self.counts[:, 0] * weights[0]).tolist()
        for k in range(len(feature) - 1, -1, -1):  # children come after their node
            a = child[k]
            if feature[k] >= 0 and feature[a] < 0 and feature[a + 1] < 0 and vote[a] == vote[a + 1]:
                feature[k] = -1
        place, kept = {0: 0}, [0]
        for k in kept:
            if feature[k] >= 0:
                for c in (child[k], child[k] + 1):
                    place[c] = len(kept)
                    kept.append(c)
        new = [place[child[k]] if feature[k] >= 0 else 0 for k in kept]
        inner = np.array([feature[k] >= 0 for k in kept])
        return Tree(np.where(inner, self.feature[kept], -1), self.cut[kept], np.array(new, np.int32), np.where(inner, self.gain[kept], 0.0), self.counts[kept])


def reached(feature, cut, child, depth: int, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The node that each of ``rows`` (places in the columns of ``values``)
    comes to after ``depth`` steps."""
    inner = feature >= 0
    first = np.where(inner, feature, 0).astype(np.intp) * values.shape[1]
    cut = np.where(inner, cut, 255).astype(np.uint8)
    child = np.where(inner, child, np.arange(len(feature))).astype(np.intp)
    at, flat = np.zeros(len(rows), np.intp), values.ravel()
    for _ in range(depth):
        at = child.take(at) + (flat.take(first.take(at) + rows) > cut.take(at))
    return at


def seen_features(p: Params, tree: int, level: int, nodes: int, features: int) -> np.ndarray:
    """(nodes, √features): what each open node may split on."""
    k = max(1, math.ceil(math.sqrt(features)))
    order = np.random.default_rng((p.seed, tree, level, 1)).random((nodes, features)).argsort(axis=1)
    return np.sort(order[:, :k], axis=1)


def drawn(p: Params, tree: int, part: int, n: int) -> np.ndarray:
    """How often a tree sees each row of a block, the same on every attempt."""
    return COUNTS[np.random.default_rng((p.seed, tree, part)).integers(0, 65_536, n, dtype=np.uint16)]


def level_sums(part: int, values: np.ndarray, p: Params, sizes: np.ndarray, level: int, trees: dict, nodes: dict):
    """((tree, first of a group of open nodes), sums): by node, seen feature,
    bin and class. ``values`` holds twice the bin plus the class."""
    features, n = values.shape
    flat = values.ravel()
    for t, tree in trees.items():
        sub = seen_features(p, t, level, len(nodes[t]), features)
        ends = np.cumsum(2 * sizes[sub].ravel()).reshape(sub.shape)
        begin, column = ends - 2 * sizes[sub], sub * n
        slot_of = np.full(len(tree.feature), -1, np.intp)
        slot_of[nodes[t]] = np.arange(len(nodes[t]))
        times = drawn(p, t, part, n)
        rows = np.flatnonzero(times)
        sums = np.zeros(ends[-1, -1])
        for a in range(0, len(rows), B.CHUNK):
            some = rows[a:a + B.CHUNK]
            slot = slot_of.take(reached(tree.feature, 2 * tree.cut.astype(np.int16) + 1, tree.child, level, values, some))
            inside = slot >= 0
            some, slot = some[inside], slot[inside]
            at = [begin[:, j].take(slot) + flat.take(column[:, j].take(slot) + some) for j in range(sub.shape[1])]
            sums += np.bincount(np.concatenate(at), weights=np.tile(times[some], sub.shape[1]), minlength=len(sums))
        sums = sums.astype(np.int32)
        for g in range(0, len(nodes[t]), NODES_A_KEY):
            last = min(g + NODES_A_KEY, len(nodes[t])) - 1
            yield (t, g), sums[begin[g, 0]:ends[last, -1]]


def best(sums: np.ndarray, sub: np.ndarray, sizes: np.ndarray, p: Params, weights: tuple[float, float]) -> np.ndarray:
    """For each node: weighted gain (0: no split), feature, cut, classes of the
    left side and of the node."""
    nodes, k = sub.shape
    size = sizes[sub].ravel()
    cells = np.zeros((nodes * k, int(sizes.max()), 2))
    cells[np.repeat(np.arange(nodes * k), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = sums.reshape(-1, 2)
    left = cells.cumsum(axis=1).reshape(nodes, k, -1, 2)
    total = left[:, :, -1:, :]
    right = total - left
    w = np.array(weights)

    def impure(c):  # the weight times the Gini impurity
        c = c * w
        whole = c.sum(axis=-1)
        return whole - (c ** 2).sum(axis=-1) / np.maximum(whole, 1e-300)
    gain = impure(total) - impure(left) - impure(right)
    ok = (left.sum(-1) >= p.min_rows) & (right.sum(-1) >= p.min_rows) & (gain > 1e-9)
    gain = np.where(ok, gain, 0.0).reshape(nodes, -1)
    at, row = gain.argmax(axis=1), np.arange(nodes)
    j, cut = at // left.shape[2], at % left.shape[2]
    return np.column_stack([gain[row, at], sub[row, j], cut, left[row, j, cut], total[row, 0, 0]])


def _blocks(df: DataFrame, features: list[str], label: str, table: B.Binning):
    """RDD of (partition, values by feature and row)."""
    picked = df.select(F.col(label).cast("int").alias("y"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{k}") for k, c in enumerate(features)])

    def cut(batches):
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]])
            values = 2 * table.bins(x).T + (b.column(0).to_numpy(zero_copy_only=False) > 0).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary())], names=["v"])

    def one(part, got):
        yield part, np.concatenate([np.empty((len(features), 0), np.uint8), *[np.frombuffer(r.v, np.uint8).reshape(len(features), -1) for r in got]], axis=1)
    return picked.mapInArrow(cut, "v binary").rdd.mapPartitionsWithIndex(one, preservesPartitioning=True)


def forest(df: DataFrame, features: list[str], p: Params, weights: tuple[float, float], label: str = "is_denied") -> ForestModel:
    """Train on the labelled rows of ``df``; ``weights`` are those of a negative
    and a positive row."""
    spark = df.sparkSession
    ship(spark)
    sc = spark.sparkContext
    n = df.count()
    parts = max(1, math.ceil(n / B.ROWS_A_BLOCK), min(sc.defaultParallelism, math.ceil(n / B.LEAST_ROWS)))
    df = cut_lineage(df.select(label, *features).repartition(parts))
    table = B.binning(df, features, p.bins)
    sizes = np.diff(table.starts)
    blocks = _blocks(df, features, label, table).persist(StorageLevel.MEMORY_AND_DISK)
    trees = [Tree.leaves(np.zeros((1, 2))) for _ in range(p.trees)]
    open_ = {t: np.array([0]) for t in range(p.trees)}
    for level in range(p.depth):
        nxt = {}
        for some in _passes(open_, sizes):
            got: dict = {t: [] for t in some}
            sent = sc.broadcast(({t: trees[t] for t in some}, {t: open_[t] for t in some}))
            for (t, first), splits in _level(blocks, p, sizes, weights, level, sent, {t: len(open_[t]) for t in some}):
                got[t].append((first, splits))
            sent.destroy()
            for t, found in got.items():
                if not found:  # no rows at all
                    continue
                trees[t], new = trees[t].grown(open_[t], np.concatenate([s for _, s in sorted(found, key=lambda x: x[0])]))
                c = trees[t].counts[new]
                new = new[(c.min(axis=1) > 0) & (c.sum(axis=1) >= 2 * p.min_rows)]
                if len(new):
                    nxt[t] = new
        open_ = nxt
        if not open_:
            break
    blocks.unpersist()
    return ForestModel(features, [_raw(t.pruned(weights), table, weights) for t in trees], p.depth)


def _passes(open_: dict, sizes: np.ndarray):
    """Trees whose open nodes' sums fit into one pass together."""
    cell, some, full = 8 * 2 * math.ceil(math.sqrt(len(sizes))) * float(sizes.mean()), [], 0.0
    for t, nodes in open_.items():
        if some and full + cell * len(nodes) > PASS_BYTES:
            yield some
            some, full = [], 0.0
        some.append(t)
        full += cell * len(nodes)
    if some:
        yield some


def _level(blocks, p, sizes, weights, level, sent, counts: dict):
    features = len(sizes)

    def sums(pair):
        return level_sums(pair[0], pair[1], p, sizes, level, *sent.value)

    def splits(pair):
        (t, first), added = pair
        sub = seen_features(p, t, level, counts[t], features)[first:first + NODES_A_KEY]
        return (t, first), best(added, sub, sizes, p, weights)
    keys = sum(-(-c // NODES_A_KEY) for c in counts.values())
    return blocks.flatMap(sums).reduceByKey(lambda a, b: a + b, max(1, keys // KEYS_A_REDUCER)).map(splits).collect()


def _raw(tree: Tree, table: B.Binning, weights):
    """(feature, threshold, child, value, gain) of every node."""
    at = [float(table.edges[f][c]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut)]
    w = tree.counts * np.array(weights)
    whole = w.sum(axis=1)
    value = np.divide(w[:, 1], whole, out=np.full(len(w), 0.5), where=whole > 0)
    return tree.feature.astype(np.int32), np.array(at), tree.child, value, tree.gain


NODES = "tree INT, node INT, feature INT, threshold DOUBLE, child INT, value DOUBLE, gain DOUBLE"


class ForestModel(Model, MLWritable, MLReadable):
    """Trees over raw feature values: rows with value <= threshold go left."""

    def __init__(self, features: list[str], trees: list, depth: int):
        super().__init__()
        self.features, self.trees, self.depth = features, trees, depth

    @property
    def featureImportances(self) -> DenseVector:
        total = np.zeros(len(self.features))
        for feature, _, _, _, gain in self.trees:
            one = np.bincount(feature[feature >= 0], weights=gain[feature >= 0], minlength=len(total))
            total += one / max(one.sum(), 1e-300)
        return DenseVector(total / max(total.sum(), 1e-300))

    def probabilities(self):
        """A function from rows of feature values to their mean votes."""
        edges = [np.unique(np.concatenate([t[1][t[0] == k] for t in self.trees])) for k in range(len(self.features))]
        cuts = []
        for feature, threshold, *_ in self.trees:
            cut = np.zeros(len(feature), np.int64)
            for k, e in enumerate(edges):
                cut[feature == k] = np.searchsorted(e, threshold[feature == k])
            cuts.append(cut)

        def of(x: np.ndarray) -> np.ndarray:
            values, rows, out = np.ascontiguousarray(B.Binning(edges).bins(x).T), np.arange(len(x)), np.zeros(len(x))
            for (feature, _, child, value, _), cut in zip(self.trees, cuts):
                out += value.take(reached(feature, cut, child, self.depth, values, rows))
            return out / max(len(self.trees), 1)
        return of

    def _transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        ship(spark)
        at = [df.columns.index(c) for c in self.features]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", `__p` double"
        sent = spark.sparkContext.broadcast((self.features, self.trees, self.depth))

        def run(batches):
            of = ForestModel(*sent.value).probabilities()
            for b in batches:
                x = np.column_stack([b.column(k).cast(pa.float64()).to_numpy(zero_copy_only=False) for k in at]) if b.num_rows else np.empty((0, len(at)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(of(x), pa.float64())], names=[*b.schema.names, "__p"])
        p = F.col("__p")
        return (df.mapInArrow(run, schema).withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", (p > 0.5).cast("double")).drop("__p"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    """The metadata of a pipeline's stage and a Parquet table of nodes."""

    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"features": m.features, "trees": len(m.trees), "depth": m.depth})
        sizes = [len(t[0]) for t in m.trees]
        each = [np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), np.concatenate([np.arange(s, dtype=np.int32) for s in sizes]),
                *[np.concatenate([t[k] for t in m.trees]) for k in range(5)]]
        nodes = spark.createDataFrame(pa.table(each, names=["tree", "node", "feature", "threshold", "child", "value", "gain"]), NODES)
        nodes.coalesce(1).write.mode("overwrite").parquet(files.join_path(path, "nodes"))


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        nodes = spark.read.schema(NODES).parquet(files.join_path(path, "nodes")).orderBy("tree", "node").toArrow()
        cols = [nodes.column(k).to_numpy() for k in range(7)]
        ends = np.searchsorted(cols[0], np.arange(meta["trees"] + 1))
        trees = [tuple(c[a:b] for c in cols[2:]) for a, b in zip(ends[:-1], ends[1:])]
        return ForestModel(list(meta["features"]), trees, meta["depth"])
