"""SimHash near-duplicate classes with bit-sliced comparison.

1. Fingerprints: 64 majority bits over the XXH64 of every word shingle.
2. Candidate blocks: two fingerprints within ``radius`` bits agree on two of
   ``radius + 2`` bit parts, so each distinct fingerprint enters one block for
   every pair of parts. A block over ``BLOCK_LIMIT`` is split again by the
   same rule on the bits that its members may still differ in, until at most
   ``LAST_BITS`` are free, which bounds it by 2**LAST_BITS members.
3. Inside a block the fingerprints lie as vertical bit planes. Planes of
   differences go through carry-save counters, 64 pairs a machine word; words
   whose pairs all exceed the radius are abandoned. A block yields a spanning
   forest of its links, never all its pairs.
4. Components: minimum label over links with pointer jumping, each round
   written to the shared folder.

Exact copies share a fingerprint and are one node from step 2 on.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, ship, written

SHINGLE, RADIUS, SEED = 3, 3, 42
BLOCK_LIMIT = 32_768     # members that one task compares directly
LAST_BITS = 14
SMALL = 64               # blocks up to this size are compared pair by pair, many at once
PAIR_LANES = 1 << 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
CHUNK = 1 << 15


# --- fingerprints -----------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text; 0 if it has no words."""
    import xxhash
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    h64 = xxhash.xxh64_intdigest
    if n <= shingle:
        return h64(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:n - shingle] + 1)).tolist()
    ends = ends[shingle - 1:].tolist()
    m = len(starts)
    votes = np.zeros(64, np.int64)
    for k in range(0, m, CHUNK):
        h = np.array([h64(joined[a:b], SEED) for a, b in zip(starts[k:k + CHUNK], ends[k:k + CHUNK])], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > m, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp): fp is the fingerprint's bits as a signed long."""
    ship(docs.sparkSession)

    def rows(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(released(rows), f"id {picked.schema['id'].dataType.simpleString()}, fp long")


# --- bit-sliced comparison --------------------------------------------------

def planes_of(values: np.ndarray) -> np.ndarray:
    """(64, words): plane b holds bit b of every value, 64 values a word."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pad = -len(values) % 64
    if pad:
        bits = np.vstack([bits, np.zeros((pad, 64), np.uint8)])
    return np.ascontiguousarray(np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")).view("<u8")


class Counters:
    """Vertical counters that saturate above ``radius`` (below 2**k - 1)."""

    def __init__(self, shape, radius: int):
        self.k = (radius + 1).bit_length()
        self.radius = radius
        self.c = [np.zeros(shape, np.uint64) for _ in range(self.k)]
        self.over = np.zeros(shape, np.uint64)

    def _carry(self, carry, level):
        """Add words of weight 2**level."""
        for i in range(level, self.k):
            c = self.c[i]
            nxt = c & carry
            c ^= carry
            carry = nxt
        self.over |= carry

    def add3(self, x, y, z):
        """Carry-save: three planes become one sum and one carry plane."""
        t = x ^ y
        self._carry(t ^ z, 0)
        self._carry((x & y) | (t & z), 1)

    def add1(self, x):
        self._carry(x, 0)

    def beyond(self):
        """Lanes whose count exceeds the radius."""
        gt, eq = self.over.copy(), ~self.over
        for i in range(self.k - 1, -1, -1):
            if self.radius >> i & 1:
                eq &= self.c[i]
            else:
                gt |= eq & self.c[i]
                eq &= ~self.c[i]
        return gt

    def keep(self, cols):
        self.c = [x[..., cols] for x in self.c]
        self.over = self.over[..., cols]


def within(diff_plane, n_words: int, lead: tuple, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Lanes at distance <= radius. ``diff_plane(b, cols)`` gives plane b of
    the differences, shape ``lead + (len(cols),)``. Returns the word columns
    that were not abandoned and the lanes' bits in them."""
    cols = np.arange(n_words)
    cnt = Counters(lead + (n_words,), radius)
    for b in range(0, 64, 8):
        p = [diff_plane(b + k, cols) for k in range(8)]
        cnt.add3(p[0], p[1], p[2])
        cnt.add3(p[3], p[4], p[5])
        cnt.add1(p[6])
        cnt.add1(p[7])
        alive = cnt.beyond() != ALL
        for _ in lead:
            alive = alive.any(axis=0)
        if not alive.all():
            cols = cols[alive]
            cnt.keep(alive)
            if not len(cols):
                break
    return cols, ~cnt.beyond()


def _lanes(bits: np.ndarray) -> np.ndarray:
    """Set bits of a row of words, as lane numbers."""
    return np.flatnonzero(np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), bitorder="little"))


def link_pairs(fps: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs (i, j) are within the radius."""
    ok = np.zeros(len(i), bool)
    for k in range(0, len(i), PAIR_LANES):
        d = planes_of(fps[i[k:k + PAIR_LANES]] ^ fps[j[k:k + PAIR_LANES]])
        cols, bits = within(lambda b, c: d[b][c], d.shape[1], (), radius)
        n = min(PAIR_LANES, len(i) - k)
        hit = np.zeros(d.shape[1], np.uint64)
        hit[cols] = bits
        ok[k:k + n][_lanes(hit)[_lanes(hit) < n]] = True
    return ok


def link_block(fps: np.ndarray, radius: int) -> np.ndarray:
    """Component root (an index) of every member of one large block: a
    breadth-first search that compares up to 64 members at a time with all."""
    n = len(fps)
    planes = planes_of(fps)
    w = planes.shape[1]
    root = np.full(n, -1, np.int64)
    free = np.zeros(w * 64, np.uint8)
    free[:n] = 1
    free = np.packbits(free, bitorder="little").view("<u8").copy()
    for start in range(n):
        if root[start] >= 0:
            continue
        root[start] = start
        free[start >> 6] &= ~np.uint64(1 << (start & 63))
        frontier = [start]
        while frontier:
            q, frontier = np.array(frontier[:64]), frontier[64:]
            live = np.flatnonzero(free)
            if not len(live):
                break
            flip = np.where(fps[q][None, :] >> np.arange(64, dtype=np.uint64)[:, None] & np.uint64(1), ALL, np.uint64(0))
            cols, bits = within(lambda b, c: planes[b][live[c]][None, :] ^ flip[b][:, None], len(live), (len(q),), radius)
            if len(cols):
                at = live[cols]
                new = np.bitwise_or.reduce(bits, axis=0) & free[at]
                got = _lanes(new)
                lanes = at[got >> 6] * 64 + (got & 63)
                if len(lanes):
                    free[at] &= ~new
                    root[lanes] = start
                    frontier.extend(lanes.tolist())
    return root


def small_roots(fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int) -> np.ndarray:
    """Component roots in many small blocks, laid one after the other."""
    root = np.arange(len(fps))
    for n in np.unique(sizes):
        if n < 2:
            continue
        a, b = np.triu_indices(n, 1)
        at = starts[sizes == n]
        step = max(1, PAIR_LANES // len(a))
        for k in range(0, len(at), step):
            i = (at[k:k + step, None] + a).ravel()
            j = (at[k:k + step, None] + b).ravel()
            ok = link_pairs(fps, i, j, radius)
            i, j = i[ok], j[ok]
            while len(i):
                low = np.minimum(root[i], root[j])
                before = root.copy()
                np.minimum.at(root, i, low)
                np.minimum.at(root, j, low)
                root = root[root]
                if (root == before).all():
                    break
    return root


def block_links(radius: int):
    """mapInArrow function over rows (mask, val, fp) sorted by (mask, val):
    the links (a, b) of a spanning forest of every block."""

    def solve(key, fps):
        cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        starts = np.concatenate(([0], cut))
        sizes = np.diff(np.concatenate((starts, [len(fps)])))
        root = np.arange(len(fps))
        big = sizes > SMALL
        for s, n in zip(starts[big].tolist(), sizes[big].tolist()):
            root[s:s + n] = s + link_block(fps[s:s + n], radius)
        small = small_roots(fps, starts[~big], sizes[~big], radius)
        root = np.where(small != np.arange(len(fps)), small, root)
        hit = np.flatnonzero(root != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(fps[hit].view(np.int64)), pa.array(fps[root[hit]].view(np.int64))], ["a", "b"])

    def run(batches):
        key, fps = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            key = np.vstack([key, k])
            fps = np.concatenate([fps, batch.column(2).to_numpy().astype(np.int64).view(np.uint64)])
            last = np.flatnonzero((key[:-1] != key[-1]).any(axis=1))
            if len(last):  # the last block may go on in the next batch
                n = last[-1] + 1
                yield solve(key[:n], fps[:n])
                key, fps = key[n:], fps[n:]
        if len(fps):
            yield solve(key, fps)

    return run


# --- blocks and components --------------------------------------------------

def signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def refine_masks(mask: int, radius: int) -> list[int]:
    """``mask`` plus every pair of parts of its free bits: fingerprints that
    agree on ``mask`` and differ in at most ``radius`` bits agree on one."""
    free = [b for b in range(64) if not mask >> b & 1]
    parts = [sum(1 << int(b) for b in p) for p in np.array_split(free, radius + 2)]
    return [mask | x | y for x, y in combinations(parts, 2)]


def links(nodes: DataFrame, radius: int, block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """Spanning links (a, b) among distinct fingerprints ``nodes(fp)``."""
    ship(nodes.sparkSession)
    found, masks, rows = None, {0}, nodes.select(F.lit(0).cast("long").alias("mask"), "fp")
    while True:
        finer = {m: refine_masks(m, radius) for m in masks}
        table = F.create_map(*[x for m, fs in finer.items() for x in (F.lit(signed(m)).cast("long"), F.array(*[F.lit(signed(f)).cast("long") for f in fs]))])
        keyed = rows.select(F.explode(table[F.col("mask")]).alias("mask"), "fp").select(
            "mask", F.col("mask").bitwiseAND(F.col("fp")).alias("val"), "fp")
        if len(masks) > 1 or 0 not in masks:
            keyed = keyed.distinct()  # parts of several coarser blocks can meet in one
        sizes = keyed.groupBy("mask", "val").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = written(keyed.join(sizes, ["mask", "val"]), "simhash-blocks")
        masks = {f for fs in finer.values() for f in fs}
        last = all(64 - bin(m).count("1") <= LAST_BITS for m in masks)
        direct = members if last else members.where(F.col("n") <= block_limit)
        part = (direct.select("mask", "val", "fp").repartition("mask", "val").sortWithinPartitions("mask", "val")
                .mapInArrow(block_links(radius), "a long, b long"))
        found = part if found is None else found.unionByName(part)
        if last:
            return found
        rows = members.where(F.col("n") > block_limit).select("mask", "fp")
        masks = {r.mask % (1 << 64) for r in rows.select("mask").distinct().collect()}  # at most 10 a level and mask
        if not masks:
            return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the smallest
    node that it reaches."""
    both = written(edges.union(edges.select("b", "a")).distinct().toDF("u", "v"), "simhash-links")
    labels = both.select(F.col("u").alias("node")).distinct().withColumn("root", F.col("node"))
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "root"), "v").groupBy(F.col("u").alias("node")).agg(F.min("root").alias("low"))
        hooked = written(labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "low").alias("root")), "simhash-labels")
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("to"))
        jumped = written(hooked.join(jump, "root").select("node", "old", F.col("to").alias("root")), "simhash-labels")
        labels = jumped.select("node", "root")
        if jumped.where("old <> root").isEmpty():
            return labels


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       radius: int = RADIUS, block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """One row per input row: id, ``fp`` (signed long) and ``component_id``,
    the smallest id whose fingerprint is reachable over links of at most
    ``radius`` bits.

    A text without words has fingerprint 0 and links like any other; null
    texts count as empty. Null ids take part but are never a component's id
    unless it has no other. Repeated rows stay rows of their own.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-nodes")
    label = components(links(nodes, radius, block_limit))
    low = nodes.join(label, F.col("fp") == F.col("node")).select("fp", "root", "low")
    best = low.groupBy("root").agg(F.min("low").alias("best"))
    linked = low.select("fp", "root").join(best, "root").select("fp", "best")
    ids = written(nodes.join(linked, "fp", "left").select("fp", F.coalesce("best", "low").alias("component_id")), "simhash-ids")
    return rows.join(ids, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
