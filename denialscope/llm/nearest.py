"""Approximate nearest neighbours by inner product, over graph shards.

1. Rows with equal vectors are one node; it keeps the smallest ``k + 1`` ids of
   its rows, which is all that an answer can need of them. A vector that a
   third of all rows have is cut to so many rows before the shuffle (a window
   with a limit), not in one task.
2. Nodes are dealt to shards of about ``shard_rows``: by length, in bands of
   the ratio ``BAND``, and within a band by a hash of the vector. Each shard
   becomes one row: vectors, node ids and a robust-pruned directed graph
   (``graph_index``). For the graph a vector gets one more component that makes
   all of a shard equally long, so that nearness in the graph is the order of
   inner products; since lengths in a shard differ little, that component is
   small and queries, which have none, lie near the nodes.
3. Queries are packed in blocks of ``BLOCK``; every block meets every shard
   of its number of components once (keys shard and block), and a beam search gives each
   query's ``k + 1`` best nodes there, scored in double precision on the
   vectors as given.
4. Each query keeps its best nodes over all shards, the nodes' rows follow, its
   own row goes, and the best ``k`` rows stay.

A shard's size bounds a task's memory and keeps the recall the same at every
number of rows; the time of a query grows with the number of shards. The
driver gets one row a number of components and band.

Vectors that are null, empty, zero, or hold null or non-finite components, and
rows without an id, take no part. Only vectors with as many components are compared.
Repeated rows are rows of their own: a copy of the query's row under the same
id is a candidate. With fewer than ``k`` candidates all are returned (a beam is
at least as wide), and an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written

K = 20
SHARD_ROWS = 8192
BEAM = 128
BLOCK = 16_384
BAND = 1.15

INDEX = "dim int, shard int, x binary, vids binary, ids binary, graph binary, entries binary"
PACKED = "dim int, block int, uids binary, ids binary, q binary"
FOUND = "quid long, qid long, vid long, id long, score double"


def usable(vec: Column) -> Column:
    """Whether a vector takes part."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return F.coalesce(~F.exists(vec, bad) & F.exists(vec, lambda v: v != 0), F.lit(False))


def band(vec: Column) -> Column:
    """Number of the vector's band of lengths."""
    most = F.array_max(F.transform(vec, lambda v: F.abs(v).cast("double")))
    square = F.aggregate(vec, F.lit(0.0), lambda acc, v: acc + (v / most) * (v / most))
    return F.round((F.log(most) + F.log(square) / 2) / math.log(BAND)).cast("int")


def _rows(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column as a matrix."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def graph_vectors(x: np.ndarray) -> np.ndarray:
    """Unit rows with one component more, whose inner product with (q, 0) is in
    proportion to that of ``x`` with q."""
    x = x / np.abs(x).max()
    square = np.einsum("ij,ij->i", x, x)
    most = square.max()
    return (np.column_stack([x, np.sqrt(np.maximum(most - square, 0))]) / math.sqrt(most)).astype(np.float32)


def build_shard(key, table):
    from .graph_index import build
    dim, shard = (k.as_py() for k in key)
    x = _rows(table["vec"], dim)
    graph, entries = build(graph_vectors(x))
    width = np.int64(graph.shape[1]).tobytes()
    row = {"dim": dim, "shard": shard, "x": x.tobytes(), "vids": table["vid"].to_numpy().tobytes(), "ids": table["id"].to_numpy().tobytes(),
           "graph": width + graph.tobytes(), "entries": entries.astype(np.int32).tobytes()}
    return pa.Table.from_pylist([row], pa.schema([("dim", pa.int32()), ("shard", pa.int32()), *[(c, pa.binary()) for c in ("x", "vids", "ids", "graph", "entries")]]))


def pack_block(key, table):
    dim, block = (k.as_py() for k in key)
    row = {"dim": dim, "block": block, "uids": table["uid"].to_numpy().tobytes(), "ids": table["id"].to_numpy().tobytes(), "q": _rows(table["vec"], dim).tobytes()}
    return pa.Table.from_pylist([row], pa.schema([("dim", pa.int32()), ("block", pa.int32()), *[(c, pa.binary()) for c in ("uids", "ids", "q")]]))


def searcher(k: int, beam: int):
    """Function of one shard and one block of queries, for a cogroup."""
    def run(shard, block):
        from .graph_index import CELLS, search
        out = {c: [] for c in ("quid", "qid", "vid", "id", "score")}
        s, b = shard.to_pylist(), block.to_pylist()
        if s and b:
            s, b = s[0], b[0]
            num = lambda data, kind: np.frombuffer(data, kind)
            x, q = num(s["x"], np.float64).reshape(-1, s["dim"]), num(b["q"], np.float64).reshape(-1, s["dim"])
            vids, ids, uids, qids = num(s["vids"], np.int64), num(s["ids"], np.int64), num(b["uids"], np.int64), num(b["ids"], np.int64)
            graph = num(s["graph"][8:], np.int32).reshape(len(x), -1)
            nodes = graph_vectors(x)
            asked = np.column_stack([_unit(q), np.zeros(len(q))]).astype(np.float32)
            step = max(1, min(1024, CELLS // (len(x) + 1)))
            for a in range(0, len(q), step):
                found, _ = search(nodes, graph, num(s["entries"], np.int32), asked[a:a + step], max(beam, k + 1))
                row, col = np.nonzero(found >= 0)
                node = found[row, col]
                score = np.einsum("ij,ij->i", x[node], q[a + row])
                order = np.lexsort((ids[node], -score, row))
                row, node, score = row[order], node[order], score[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                keep = rank <= k
                row, node = row[keep] + a, node[keep]
                for c, v in (("quid", uids[row]), ("qid", qids[row]), ("vid", vids[node]), ("id", ids[node]), ("score", score[keep])):
                    out[c].append(v)
        kinds = {"score": np.float64}
        return pa.table({c: np.concatenate(v) if v else np.empty(0, kinds.get(c, np.int64)) for c, v in out.items()})
    return run


def nearest_neighbours(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
                       shard_rows: int = SHARD_ROWS, beam: int = BEAM) -> DataFrame:
    """``query_id, rank, <id_col>, score``: for each row with ``is_query``, the
    ``k`` rows of largest inner product found, nearest first, ties to the
    smaller id. ``id_col`` holds integers."""
    ship(rows.sparkSession)
    vec = F.col(f"`{vec_col}`")
    told = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.monotonically_increasing_id().alias("uid"), vec.alias("vec"),
                       F.size(vec).alias("dim"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    told = written(told.where(F.col("id").isNotNull() & usable(F.col("vec"))), "ann-rows")

    within = Window.partitionBy("vec").orderBy("id", "uid")
    first = told.select("id", "uid", "vec", "dim").withColumn("nth", F.row_number().over(within)).where(F.col("nth") <= k + 1)
    nodes = first.groupBy("vec").agg(F.first("dim").alias("dim"), F.array_sort(F.collect_list(F.struct("id", "uid"))).alias("rows"))
    nodes = written(nodes.select("vec", "dim", F.col("rows")[0]["uid"].alias("vid"), F.col("rows")[0]["id"].alias("id"), "rows", band(F.col("vec")).alias("band")), "ann-nodes")
    asked = told.where("asks")

    def pieces(df, keys, size):
        """Key -> (first, number) of pieces of about ``size`` rows, numbered
        through for each number of components; and how many those have."""
        place, total = {}, {}
        for r in df.groupBy("dim", *keys).count().collect():
            n = -(-r["count"] // size)
            place["|".join(str(v) for v in r[:-1])] = (total.get(r["dim"], 0), n)
            total[r["dim"]] = total.get(r["dim"], 0) + n
        return place, total

    def look_up(table, key):
        pairs = [F.lit(v) for kv in (table or {"": 1}).items() for v in kv]
        return F.create_map(*pairs)[key.cast("string")]

    def piece(place, keys, hashed):
        key = F.concat_ws("|", "dim", *keys)
        first, n = (look_up({k: v[i] for k, v in place.items()}, key) for i in (0, 1))
        return (first + F.pmod(hashed, n)).cast("int")

    def all_of(total):
        n = F.coalesce(look_up({str(k): v for k, v in total.items()}, F.col("dim")), F.lit(0))
        return F.explode(F.filter(F.sequence(F.lit(0), n), lambda i: i < n))

    (shard_of, shards), (block_of, blocks) = pieces(nodes, ["band"], shard_rows), pieces(asked, [], BLOCK)
    shard = piece(shard_of, ["band"], F.xxhash64("vec")).alias("shard")
    index = written(nodes.select("dim", shard, "vec", "vid", "id").groupBy("dim", "shard").applyInArrow(build_shard, INDEX), "ann-index")
    block = piece(block_of, [], F.xxhash64("uid")).alias("block")
    queries = written(asked.select("dim", block, "vec", "uid", "id").groupBy("dim", "block").applyInArrow(pack_block, PACKED), "ann-queries")

    # a stated query set against all shards, block by block
    left = index.withColumn("block", all_of(blocks)).groupBy("dim", "shard", "block")
    right = queries.withColumn("shard", all_of(shards)).groupBy("dim", "shard", "block")
    found = left.cogroup(right).applyInArrow(searcher(k, beam), FOUND)

    best = Window.partitionBy("quid").orderBy(F.desc("score"), "id")
    met = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).select("quid", "qid", "vid", "score")
    each = met.join(nodes.select("vid", "rows"), "vid").select("quid", "qid", "score", F.explode("rows").alias("r")).where(F.col("r.uid") != F.col("quid"))
    last = Window.partitionBy("quid").orderBy(F.desc("score"), "r.id", "r.uid")
    return each.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select(
        F.col("qid").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("r.id").alias(id_col), "score")
