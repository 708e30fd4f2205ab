"""Second-order histogram boosting of many fits at once, level by level.

A fit is a candidate's parameters and the fold that it leaves out. All fits of
a run share one binned table and every pass over it:

* The table is cut into bins once (approximate quantiles, at most ``bins``
  a feature) and kept as one compact block a partition: bins, labels, folds,
  and every fit's margin. Features of few bins share a column of the block
  (``packing``): it is counted once for all of them, and each feature's sums
  are the margins of the common ones. Blocks are persisted, and checkpointed to the shared
  folder every ``CHECKPOINT`` rounds, so a lost executor costs some rounds.
* A pass grows one level of the current tree of every fit: tasks sum gradients
  and hessians by (fit, node, feature, bin), a shuffle adds the sums up by
  (fit, group of nodes), and the reducing tasks find each node's best split.
  Only splits come to the driver, one row a node; where all blocks' sums are
  few (``DIRECT_BYTES``) they come there themselves, without the shuffle. A
  round of trees of depth d
  takes d passes, whatever the number of fits.
* The gain of a split is ½ (GL²/(HL+λ) + GR²/(HR+λ) − G²/(H+λ)), a leaf's value
  −rate · G/(H+λ).
* With ``leaves`` a tree is grown leaf by leaf, the largest gain first, until
  it has so many. A node's gain depends on its own rows alone, so the splits
  are those of the whole tree of that depth, taken in the order of their gain;
  a node that comes after so many others whatever lies below them is not grown
  further (``within_reach``).

The passes work on RDDs of blocks: a pass is a job of 50 milliseconds that way
and of 300 as a query, and a run has thousands. ``split_gains`` states the sums
and gains as a query.
"""

from __future__ import annotations

import heapq
import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_dir, ship
from ..sources import files

CHECKPOINT = 10
#: A block holds at most so many rows (of some 20 bytes, and 4 more a fit): a
#: task takes 10 milliseconds before it begins, and a pass has one a block.
#: Few rows spread over the cores, but not thinner than the second number.
ROWS_A_BLOCK, LEAST_ROWS = 500_000, 5_000
CHUNK = 1 << 16      # rows summed at a time
NODES_A_KEY = 16     # nodes of a fit that are added up together
NODES_A_REDUCER = 128
#: Up to so many bytes of sums of all blocks are added up on the driver: a pass
#: is one stage then and takes half the time. Rows never come there.
DIRECT_BYTES = 16 << 20
ALL_ROWS = -1        # in place of a fold: nothing is left out


@dataclass(frozen=True)
class Params:
    rounds: int = 300
    depth: int = 8
    leaves: int | None = None
    rate: float = 0.05
    rows: float = 0.8        # share of the rows a round
    columns: float = 0.8     # share of the features a tree
    bins: int = 64
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    min_child_rows: int = 1
    seed: int = 42


@dataclass(frozen=True)
class Fit:
    """One model to train: rows of ``fold`` are left out; positives weigh
    ``pos_weight``."""

    params: Params
    fold: int = ALL_ROWS
    pos_weight: float = 1.0


@dataclass
class Tree:
    """Node k is a leaf where ``feature[k]`` is -1; else rows whose bin is at
    most ``cut[k]`` go to node ``child[k]``, the rest to the one after it."""

    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    child: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])
    depth: list = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int, gain: float, left: float, right: float) -> None:
        self.feature[node], self.cut[node], self.gain[node], self.child[node] = feature, cut, gain, len(self.feature)
        for v in (left, right):
            for name, x in (("feature", -1), ("cut", 0), ("child", 0), ("value", v), ("gain", 0.0), ("depth", self.depth[node] + 1)):
                getattr(self, name).append(x)

    def best_first(self, leaves: int) -> Tree:
        """The tree of at most ``leaves`` leaves that splits the largest gain
        first (of equal gains the node found first)."""
        out, heap, n = Tree(value=[self.value[0]]), [], 1
        place = {0: 0}
        if self.feature[0] >= 0:
            heap = [(-self.gain[0], 0)]
        while heap and n < leaves:
            _, k = heapq.heappop(heap)
            left = self.child[k]
            out.split(place[k], self.feature[k], self.cut[k], self.gain[k], self.value[left], self.value[left + 1])
            n += 1
            for c in (left, left + 1):
                place[c] = out.child[place[k]] + c - left
                if self.feature[c] >= 0:
                    heapq.heappush(heap, (-self.gain[c], c))
        return out

    def within_reach(self, leaves: int) -> set[int]:
        """Nodes that can be among the first ``leaves - 1`` splits. A split
        comes no sooner than all above it: what counts is the least gain on its
        path, and what lies below has no more."""
        least = [math.inf] * len(self.feature)
        for k, f in enumerate(self.feature):
            if f >= 0:
                own = least[k] = min(least[k], self.gain[k])
                least[self.child[k]] = least[self.child[k] + 1] = own
        ranked = sorted((k for k, f in enumerate(self.feature) if f >= 0), key=lambda k: -least[k])
        return {k for k in ranked if least[k] >= least[ranked[min(leaves - 1, len(ranked)) - 1]]}

    def arrays(self):
        return np.array(self.feature, np.int32), np.array(self.cut, np.int32), np.array(self.child, np.int32), np.array(self.value, np.float64)


def packing(starts: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Columns of a block, each the (feature, stride, size) that share it: a
    row's value there is the sum of its bins times the strides, a byte."""
    columns: list = []
    for f, size in enumerate(np.diff(starts).tolist()):
        for c in columns:
            if (stride := c[-1][1] * c[-1][2]) * size <= 256:
                c.append((f, stride, size))
                break
        else:
            columns.append([(f, 1, size)])
    return columns


def packed(bins: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The columns (``packing``) of rows of bins, one after the other."""
    return np.array([sum(bins[:, f].astype(np.int64) * stride for f, stride, _ in c) for c in packing(starts)], np.uint8)


def steps(arrays, starts: np.ndarray):
    """A tree as tables: each node's column, and the node that follows it for
    each value of that column (a leaf is followed by itself); and its depth."""
    feature, cut, child, _ = arrays
    column, after = np.zeros(len(feature), np.intp), np.repeat(np.arange(len(feature), dtype=np.int32), 256).reshape(-1, 256)
    place = {f: (j, stride, size) for j, c in enumerate(packing(starts)) for f, stride, size in c}
    depth, level = 0, [0]
    while level := [k for k in level if feature[k] >= 0]:
        for k in level:
            column[k], stride, size = place[int(feature[k])]
            after[k] = child[k] + (np.arange(256) // stride % size > cut[k])
        depth, level = depth + 1, [int(c) for k in level for c in (child[k], child[k] + 1)]
    return column, after.ravel(), depth


def routed(tables, columns: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The node that each of ``rows`` of a block's ``columns`` comes to."""
    column, after, depth = tables
    values, first = columns.ravel(), column * columns.shape[1]
    at = np.zeros(len(rows), np.intp)
    for _ in range(depth):
        at = after.take((at << 8) + values.take(first.take(at) + rows))
    return at.astype(np.intp, copy=False)


def layout(starts: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Where the cells of each of ``columns`` begin when only they are summed."""
    return np.concatenate([[0], np.cumsum(np.diff(starts)[columns])])


def best_splits(sums: np.ndarray, starts: np.ndarray, p: Params):
    """For each node of ``sums`` (nodes, 2 or 3, cells) the best (gain, cell,
    GL, HL, G, H); cell -1 where no split has a positive gain."""
    nodes, _, cells = sums.shape
    first = starts[:-1]
    upto = np.cumsum(sums, axis=2)
    before = np.concatenate([np.zeros((nodes, sums.shape[1], 1)), upto], axis=2)
    left = upto - np.repeat(before[:, :, first], np.diff(starts), axis=2)
    total = upto[:, :, starts[1] - 1][:, :, None]  # every feature's cells add up to the node
    right = total - left
    part = lambda s: s[:, 0] ** 2 / np.maximum(s[:, 1] + p.reg_lambda, 1e-12)
    gain = (part(left) + part(right) - part(total)) / 2
    ok = (left[:, 1] >= p.min_child_weight) & (right[:, 1] >= p.min_child_weight)
    if sums.shape[1] > 2:
        ok &= (left[:, 2] >= p.min_child_rows) & (right[:, 2] >= p.min_child_rows)
    ok[:, starts[1:] - 1] = False
    gain = np.where(ok & (gain > 1e-9), gain, -np.inf)
    cell = gain.argmax(axis=1)
    rows = np.arange(nodes)
    best = gain[rows, cell]
    cell = np.where(np.isfinite(best), cell, -1)
    return best, cell, left[rows, 0, cell], left[rows, 1, cell], total[:, 0, 0], total[:, 1, 0]


class Binning:
    """Edges of each feature, and the cells that its bins have among all."""

    def __init__(self, edges: list[np.ndarray]):
        self.edges = edges
        self.starts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])])

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Number of edges below each value; null and NaN count as 0."""
        x = np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)
        return np.column_stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)]).astype(np.uint8)


def binning(df: DataFrame, features: list[str], bins: int) -> Binning:
    probs = [k / bins for k in range(1, bins)]
    found = df.approxQuantile(features, probs, 1 / (4 * bins))
    return Binning([np.unique([v for v in q if not math.isnan(v)]) for q in found])


def gradients(fit: Fit, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and hessians of a fit at its margins."""
    p = 1 / (1 + np.exp(-margin))
    w = np.where(y > 0, fit.pos_weight, 1.0)
    return w * (p - y), np.maximum(w * p * (1 - p), 1e-16)


def drawn(fit: Fit, index: int, round_: int, part: int, n: int) -> np.ndarray:
    """Rows of a block that a fit sees in a round, the same on every attempt."""
    return np.random.default_rng((fit.params.seed, index, round_, part)).random(n) < fit.params.rows


def level_sums(part: int, block: dict, fits: list[Fit], starts: dict, round_: int, trees: list, nodes: list, usable: list):
    """((fit, group of nodes), sums) of one block. ``trees``: arrays of every
    fit's tree so far; ``nodes``: the nodes of the level to be summed;
    ``usable``: the features of every fit's tree."""
    for k, fit in enumerate(fits):
        if not nodes[k]:
            continue
        p = fit.params
        begin = starts[p.bins]
        columns = columns_of(block, p.bins, begin)
        shared = [(j, c) for j, c in enumerate(packing(begin)) if any(f in usable[k] for f, _, _ in c)]
        rows = np.flatnonzero((block["fold"] != fit.fold) & drawn(fit, k, round_, part, len(block["y"])))
        slot_of = np.full(len(trees[k][0]), -1, np.intp)
        slot_of[nodes[k]] = np.arange(len(nodes[k]))
        tables = steps(trees[k], begin)
        stats = 3 if p.min_child_rows > 1 else 2
        common = [np.zeros((stats, len(nodes[k]), c[-1][1] * c[-1][2])) for _, c in shared]
        for a in range(0, len(rows), CHUNK):
            some = rows[a:a + CHUNK]
            slot = slot_of.take(routed(tables, columns, some))
            if (inside := slot >= 0).sum() < len(some):
                some, slot = some[inside], slot[inside]
            weights = [*gradients(fit, block["y"][some], block["margin"][k, some]), None][:stats]
            for (j, _), sums in zip(shared, common):
                size = sums.shape[2]
                at = slot * size + columns[j].take(some)
                for whole, w in zip(sums, weights):
                    whole += np.bincount(at, weights=w, minlength=len(nodes[k]) * size).reshape(-1, size)
        of = {}
        for (_, c), sums in zip(shared, common):
            # the last feature of a column varies slowest
            each = sums.reshape(stats, len(nodes[k]), *[size for _, _, size in reversed(c)])
            for i, (f, _, _) in enumerate(reversed(c)):
                of[f] = each.sum(axis=tuple(x + 2 for x in range(len(c)) if x != i))
        # half the bytes of a shuffle that is all sums; they are added up as doubles
        sums = np.concatenate([of[f] for f in usable[k]], axis=2).astype(np.float32).transpose(1, 0, 2)
        for g in range(0, len(nodes[k]), NODES_A_KEY):
            yield (k, g), np.ascontiguousarray(sums[g:g + NODES_A_KEY])


def columns_of(block: dict, bins: int, starts: np.ndarray) -> np.ndarray:
    return block[f"columns{bins}"] if f"columns{bins}" in block else packed(block[bins], starts)


def with_trees(block: dict, fits: list[Fit], starts: dict, trees: list) -> dict:
    """The block with its margins moved by one tree a fit."""
    margin = np.empty_like(block["margin"])
    for k, fit in enumerate(fits):
        bins = fit.params.bins
        tables, columns = steps(trees[k], starts[bins]), columns_of(block, bins, starts[bins])
        for a in range(0, len(block["y"]), CHUNK):
            some = slice(a, a + CHUNK)
            margin[k, some] = block["margin"][k, some] + trees[k][3][routed(tables, columns, np.arange(a, min(a + CHUNK, len(block["y"]))))]
    return block | {"margin": margin}


@dataclass
class BoostedModel:
    """Trees over raw feature values: rows with value <= threshold go left."""

    features: list[str]
    trees: list  # of (feature, threshold, child, value, gain)
    params: Params

    def margins(self, x: np.ndarray) -> np.ndarray:
        x = np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)
        out, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, threshold, child, value, _ in self.trees:
            at = np.zeros(len(x), np.int32)
            for _ in range(self.params.depth):
                f = feature[at]
                at = np.where(f >= 0, child[at] + (x[rows, np.maximum(f, 0)] > threshold[at]), at)
            out += value[at]
        return out

    def importances(self) -> list[tuple[str, float]]:
        """Each feature's share of the gain of all splits."""
        total = np.zeros(len(self.features))
        for feature, _, _, _, gain in self.trees:
            np.add.at(total, feature[feature >= 0], gain[feature >= 0])
        whole = total.sum()
        return [(f, float(v / whole) if whole else 0.0) for f, v in zip(self.features, total)]

    def transform(self, df: DataFrame, probability: str = "p_denial") -> DataFrame:
        """The rows and columns of ``df`` plus the probability."""
        ship(df.sparkSession)
        at = [df.columns.index(c) for c in self.features]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{probability}` double"
        def run(batches):
            for b in batches:
                x = np.column_stack([b.column(k).cast(pa.float64()).to_numpy(zero_copy_only=False) for k in at]) if b.num_rows else np.empty((0, len(at)))
                p = 1 / (1 + np.exp(-self.margins(x)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], names=[*b.schema.names, probability])
        return df.mapInArrow(run, schema)

    def save(self, spark: SparkSession, path: str) -> None:
        """A Parquet table of nodes and a row of parameters."""
        rows = [(t, k, int(f[k]), float(x[k]), int(c[k]), float(v[k]), float(g[k])) for t, (f, x, c, v, g) in enumerate(self.trees) for k in range(len(f))]
        nodes = spark.createDataFrame(rows, "tree INT, node INT, feature INT, threshold DOUBLE, child INT, value DOUBLE, gain DOUBLE")
        nodes.coalesce(1).write.mode("overwrite").parquet(files.join_path(path, "nodes"))
        meta = spark.createDataFrame([(json.dumps(asdict(self.params)), self.features, len(self.trees))], "params STRING, features ARRAY<STRING>, trees INT")
        meta.coalesce(1).write.mode("overwrite").parquet(files.join_path(path, "boosted"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedModel:
        meta = spark.read.parquet(files.join_path(path, "boosted")).first()
        by = [[] for _ in range(meta.trees)]
        for r in spark.read.parquet(files.join_path(path, "nodes")).orderBy("tree", "node").collect():
            by[r.tree].append(r[2:])
        trees = [tuple(np.array(c, kind) for c, kind in zip(zip(*rows), (np.int32, np.float64, np.int32, np.float64, np.float64))) for rows in by]
        return BoostedModel(list(meta.features), trees, Params(**json.loads(meta.params)))


def _blocks(df: DataFrame, features: list[str], label: str, fold: str | None, tables: dict, n_fits: int):
    """RDD of (partition, block), one block a partition."""
    picked = df.select(F.col(label).cast("float").alias("y"), (F.col(fold) if fold else F.lit(ALL_ROWS - 1)).cast("byte").alias("fold"),
                       *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{k}") for k, c in enumerate(features)])

    def cut(batches):
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[2:]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column(0).to_numpy(zero_copy_only=False).tobytes()], pa.binary()), pa.array([b.column(1).to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
                 *[pa.array([packed(t.bins(x), t.starts).tobytes()], pa.binary()) for t in tables.values()]], names=["y", "fold", *[f"b{n}" for n in tables]])

    rows = picked.mapInArrow(cut, ", ".join(["y binary", "fold binary", *[f"b{n} binary" for n in tables]])).rdd

    def one(part, got):
        got = list(got)
        whole = lambda c, kind: np.frombuffer(b"".join(r[c] for r in got), kind)
        y = whole("y", np.float32)
        yield part, {"y": y, "fold": whole("fold", np.int8), "margin": np.zeros((n_fits, len(y)), np.float32)} | {
            f"columns{n}": np.concatenate([np.empty((len(packing(t.starts)), 0), np.uint8),
                                           *[np.frombuffer(r[f"b{n}"], np.uint8).reshape(len(packing(t.starts)), -1) for r in got]], axis=1) for n, t in tables.items()}
    return rows.mapPartitionsWithIndex(one, preservesPartitioning=True)


def boost(df: DataFrame, features: list[str], fits: list[Fit], label: str = "is_denied", fold: str | None = None) -> list[BoostedModel]:
    """Train all ``fits`` on the labelled rows of ``df``; ``fold`` names the
    column of folds. The rows are written once more, in blocks of an even size
    that stay the same whenever one has to be made again."""
    spark = df.sparkSession
    ship(spark)
    sc = spark.sparkContext
    sc.setCheckpointDir(shared_dir(spark))
    n = df.count()
    parts = max(1, math.ceil(n / ROWS_A_BLOCK), min(sc.defaultParallelism, math.ceil(n / LEAST_ROWS)))
    df = cut_lineage(df.select(label, *([fold] if fold else []), *features).repartition(parts))
    tables = {n: binning(df, features, n) for n in sorted({f.params.bins for f in fits})}
    starts = {n: t.starts for n, t in tables.items()}
    blocks = _blocks(df, features, label, fold, tables, len(fits)).persist(StorageLevel.MEMORY_AND_DISK)
    models = [BoostedModel(features, [], f.params) for f in fits]
    older = None
    for round_ in range(max((f.params.rounds for f in fits), default=0)):
        trees = [Tree() for _ in fits]
        live = [round_ < f.params.rounds for f in fits]
        usable = []
        for k, f in enumerate(fits):
            rng = np.random.default_rng((f.params.seed, k, round_))
            usable.append(np.sort(rng.permutation(len(features))[:max(1, round(f.params.columns * len(features)))]))
        nodes = [[0] if on else [] for on in live]
        while any(nodes):
            arrays = [t.arrays() for t in trees]
            found = _level(blocks, fits, starts, round_, arrays, nodes, usable)
            if older is not None:  # this pass has stored the moved margins
                older.unpersist()
                older = None
            nodes = [_grow(t, f.params, layout(starts[f.params.bins], usable[k]), usable[k], nodes[k], found.get(k, {})) for k, (t, f) in enumerate(zip(trees, fits))]
        for k, f in enumerate(fits):
            if live[k] and f.params.leaves:
                trees[k] = trees[k].best_first(f.params.leaves)
            if live[k]:
                models[k].trees.append(_raw(trees[k], tables[f.params.bins]))
        arrays = [t.arrays() for t in trees]
        older, blocks = blocks, _moved(blocks, fits, starts, arrays).persist(StorageLevel.MEMORY_AND_DISK)
        if (round_ + 1) % CHECKPOINT == 0:
            blocks.checkpoint()
    if older is not None:
        older.unpersist()
    blocks.unpersist()
    return models


def _level(blocks, fits, starts, round_, arrays, nodes, usable) -> dict:
    """fit -> node -> its best split."""
    reducers = -(-sum(map(len, nodes)) // NODES_A_REDUCER)

    def sums(pair):
        return level_sums(pair[0], pair[1], fits, starts, round_, arrays, nodes, usable)

    def best(pair):
        (k, first), added = pair
        p = fits[k].params
        return k, first, [v.tolist() for v in best_splits(added, layout(starts[p.bins], usable[k]), p)]
    width = lambda k: int(layout(starts[fits[k].params.bins], usable[k])[-1]) * (3 if fits[k].params.min_child_rows > 1 else 2)
    out: dict = {}
    if 4 * blocks.getNumPartitions() * sum(len(ns) * width(k) for k, ns in enumerate(nodes)) <= DIRECT_BYTES:
        added: dict = {}
        for key, part in blocks.flatMap(sums).collect():
            added[key] = added[key] + part if key in added else _double(part)
        got = map(best, added.items())
    else:
        got = blocks.flatMap(sums).combineByKey(_double, _add, _add, reducers).map(best).collect()
    for k, first, columns in got:
        for j, row in enumerate(zip(*columns)):
            out.setdefault(k, {})[nodes[k][first + j]] = row
    return out


def _double(sums):
    return sums.astype(np.float64)


def _add(a, b):
    return a + b


def _moved(blocks, fits, starts, arrays):
    return blocks.mapValues(lambda b: with_trees(b, fits, starts, arrays))


def _grow(tree: Tree, p: Params, cells: np.ndarray, columns: np.ndarray, nodes: list[int], found: dict) -> list[int]:
    """Split what has a split; the children to be summed next."""
    nxt = []
    for node in nodes:
        if node not in found:
            continue
        gain, cell, gl, hl, g, h = found[node]
        if node == 0:
            tree.value[0] = -p.rate * g / max(h + p.reg_lambda, 1e-12)
        if cell < 0:
            continue
        place = int(np.searchsorted(cells, cell, side="right")) - 1
        value = lambda a, b: -p.rate * a / max(b + p.reg_lambda, 1e-12)
        tree.split(node, int(columns[place]), int(cell - cells[place]), gain, value(gl, hl), value(g - gl, h - hl))
        if tree.depth[node] + 1 < p.depth:
            nxt.append(node)
    reach = tree.within_reach(p.leaves) if p.leaves else nxt
    return [c for k in nxt if k in reach for c in (tree.child[k], tree.child[k] + 1)]


def _raw(tree: Tree, table: Binning):
    """The tree with thresholds in place of bins."""
    feature, cut, child, value = tree.arrays()
    at = [float(table.edges[f][c]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut)]
    return feature, np.array(at), child, value, np.array(tree.gain)


def split_gains(rows: DataFrame, features: dict[str, Column], g: Column, h: Column, reg_lambda: float = 1.0, keys: list[str] | None = None) -> DataFrame:
    """feature, bin, gain of every split (bins up to ``bin`` go left) of each
    node, for rows with gradient ``g`` and hessian ``h``. ``features`` maps a
    name to its bin column, ``keys`` name the columns of fit and node."""
    keys = keys or []
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), b.cast("int").alias("bin")) for n, b in features.items()])
    sums = (rows.select(*keys, g.alias("g"), h.alias("h"), F.explode(cells).alias("c")).groupBy(*keys, "c.feature", "c.bin")
            .agg(F.sum("g").alias("g"), F.sum("h").alias("h")))
    node = Window.partitionBy(*keys, "feature")
    left = node.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = sums.select(*keys, "feature", "bin", F.sum("g").over(left).alias("gl"), F.sum("h").over(left).alias("hl"), F.sum("g").over(node).alias("ga"),
                     F.sum("h").over(node).alias("ha"), F.max("bin").over(node).alias("last"))
    part = lambda a, b: a * a / (b + F.lit(reg_lambda))
    gl, hl, ga, ha = (F.col(c) for c in ("gl", "hl", "ga", "ha"))
    return at.where(F.col("bin") < F.col("last")).select(*keys, "feature", "bin", ((part(gl, hl) + part(ga - gl, ha - hl) - part(ga, ha)) / 2).alias("gain"))
