"""Sharding by sampled splitters, in DataFrame functions only.

1. The records' keys and sizes are written once to the shared folder, with a
   row number that tells repeated rows apart.
2. Keys are drawn with a probability in proportion to their size; the
   quantiles of the sample are the boundaries of ``pieces`` key ranges. The
   exact size of every range is then counted.
3. A record larger than half a piece is a piece of its own. A range that is
   overfull (in bytes or rows) is subdivided by splitters drawn from it alone,
   until none is: also a key that holds a third of all rows is split, since
   the id and the row number follow the key in the order.
4. Whole ranges go to shards, the largest first to the emptiest shard.
5. Positions: rows are range-partitioned by (range, key, id, row number),
   numbered in that order, and offset by the counts of the partitions before; a
   range spreads over as many partitions as its rows fill, and keeps its order.

To the driver come the total size, the sampled keys and one row a range, all
in proportion to the number of pieces and not to the input.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARDS = 40
PIECES = 16           # ranges a shard
OVERSAMPLE = 8        # sampled keys a range
FILE_ROWS = 200_000
MAX_ROUNDS = 30


def _key(k, i, u):
    return F.struct(k.cast("long").alias("sh__k"), i.cast("long").alias("sh__i"), u.cast("long").alias("sh__u"))


def _range_of(key, splitters):
    """Number of splitters <= key: a binary search in a literal array."""
    if not splitters:
        return F.lit(0)
    long = lambda v: f"{v}L" if v > -(1 << 63) else f"({v + 1}L - 1L)"
    items = ",".join(f"struct({long(a)},{long(b)},{long(c)})" for a, b, c in splitters)
    table = F.expr(f"cast(array({items}) as array<struct<k:bigint,i:bigint,u:bigint>>)")
    steps = F.array(*[F.lit(0)] * (len(splitters).bit_length()))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splitters)).alias("hi"))

    def halve(s, _):
        mid = ((s["lo"] + s["hi"]) / 2).cast("int")
        open_ = s["lo"] < s["hi"]
        right = open_ & (F.get(table, mid) <= key)
        return F.struct(F.when(right, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(open_ & ~right, mid).otherwise(s["hi"]).alias("hi"))

    return F.aggregate(steps, start, halve, lambda s: s["lo"])


def _draw(records: DataFrame, weight, wanted: float, total: float, seed: int) -> list[tuple]:
    """Sorted keys, each record drawn with probability weight * wanted / total."""
    chance = F.pmod(F.xxhash64("sh__u", "sh__k", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    got = records.where(chance < weight * (wanted / total)).select("sh__k", "sh__i", "sh__u").collect()
    return sorted((r.sh__k, r.sh__i, r.sh__u) for r in got)


def _order_of(df: DataFrame, column: str):
    """A long to order rows by: an integer itself, a hash of anything else."""
    c = F.col(f"`{column}`")
    whole = df.select(c).schema[0].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    return F.coalesce(c.cast("long") if whole else F.xxhash64(c), F.lit(0))


def assign_shards(records: DataFrame, key: str, id_col: str, size: str, shards: int = SHARDS, pieces: int = PIECES) -> DataFrame:
    """The rows and columns of ``records`` plus ``shard`` (int) and ``slot``
    (long, gapless from 0 in each shard). Shards have nearly equal sums of
    ``size``; rows of one ``key`` are neighbours wherever they fit.

    Keys and ids may be of any type: integers give the order themselves, others
    by their hash. Null keys, ids and sizes count as 0. Repeated rows are placed one by one.
    An empty table gives an empty result. Input columns named ``shard`` or
    ``slot`` are replaced.
    """
    held = [F.col(f"`{c}`") for c in records.columns if c.lower() not in ("shard", "slot")]
    base = written(records.select(*held, _order_of(records, key).alias("sh__k"),
                                  _order_of(records, id_col).alias("sh__i"), F.monotonically_increasing_id().alias("sh__u"),
                                  F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("sh__s")), "shard-input")
    total, rows = base.agg(F.sum("sh__s"), F.count("sh__s")).first()
    if not rows:
        return base.select(*held, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    n = shards * pieces
    # a row weighs its bytes plus an even share, so that ranges are bounded in both
    share = max(total, 1) / rows
    weight, whole = F.col("sh__s") + share, total + share * rows
    limit = whole / n
    heavy = F.col("sh__s") > total / n / 2
    light = base.where(~heavy)
    # records above half a piece: at most 2 n of them
    alone = sorted((r.sh__k, r.sh__i, r.sh__u, r.sh__s) for r in base.where(heavy).select("sh__k", "sh__i", "sh__u", "sh__s").collect())
    splitters = _draw(light, weight, n * OVERSAMPLE, whole, 0)[::OVERSAMPLE]
    key_of = _key(F.col("sh__k"), F.col("sh__i"), F.col("sh__u"))
    for seed in range(1, MAX_ROUNDS):
        ranged = light.select("sh__k", "sh__i", "sh__u", "sh__s", _range_of(key_of, splitters).alias("sh__r"))
        stats = ranged.groupBy("sh__r").agg(F.sum("sh__s").alias("bytes"), F.count("sh__s").alias("n")).collect()
        weight_of = {x.sh__r: x.bytes + x.n * share for x in stats}
        full = {r: w for r, w in weight_of.items() if w > limit}
        if not full or all(x.n == 1 for x in stats if x.sh__r in full):
            break
        over = ranged.where(F.col("sh__r").isin(list(full)))
        more = _draw(over, weight, OVERSAMPLE * sum(full.values()) / limit * 2, sum(full.values()), seed)
        splitters = sorted({*splitters, *more[::OVERSAMPLE // 2]})
    # largest first to the emptiest shard; its pieces then lie in key order
    todo = [(x.bytes, x.n, (0, x.sh__r)) for x in stats] + [(s, 1, (1, k, i, u)) for k, i, u, s in alone]
    heap = [(0, 0, s) for s in range(shards)]
    placed = []
    for size_, count, name in sorted(todo, key=lambda x: (-x[0], -x[1], x[2])):
        bytes_, rows_, s = heapq.heappop(heap)
        placed.append((s, name, count))
        heapq.heappush(heap, (bytes_ + size_, rows_ + count, s))
    placed.sort()
    spark = records.sparkSession
    out, before, last = [], 0, None
    for s, name, count in placed:
        before = 0 if s != last else before
        last = s
        out.append((name[0], name[1], name[2] if name[0] else None, name[3] if name[0] else None, s, before))
        before += count
    # one row a piece, of which there are a fixed multiple of the shards
    table = spark.createDataFrame(out, "kind int, a long, b long, c long, shard int, sh__first long")
    ranges = F.broadcast(table.where("kind = 0").select(F.col("a").cast("int").alias("sh__r"), "shard", "sh__first"))
    lone = F.broadcast(table.where("kind = 1").select(F.col("a").alias("sh__k"), F.col("b").alias("sh__i"), F.col("c").alias("sh__u"), "shard", "sh__first"))
    order = ["sh__r", "sh__k", "sh__i", "sh__u"]
    spot = light.select(*held, "sh__k", "sh__i", "sh__u", _range_of(key_of, splitters).alias("sh__r"))
    spot = spot.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("sh__at", F.monotonically_increasing_id())
    spot = written(spot.drop("sh__k", "sh__i", "sh__u"), "shard-order").withColumn("sh__p", F.shiftright("sh__at", 33))
    counts = spot.groupBy("sh__r", "sh__p").agg(F.count(F.lit(1)).alias("n"), F.min("sh__at").alias("first"))
    ahead = Window.partitionBy("sh__r").orderBy("sh__p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("sh__r", "sh__p", (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("first")).alias("sh__ahead"))
    many = (spot.join(counts, ["sh__r", "sh__p"]).join(ranges, "sh__r")
            .select(*held, "shard", (F.col("sh__first") + F.col("sh__ahead") + F.col("sh__at")).alias("slot")))
    single = base.where(heavy).join(lone, ["sh__k", "sh__i", "sh__u"]).select(*held, "shard", F.col("sh__first").alias("slot"))
    return many.unionByName(single)


def write_shards(records: DataFrame, path: str, key: str, id_col: str, size: str, shards: int = SHARDS) -> None:
    """Write whole records to ``path/shard=N/``, in slot order within files."""
    done = assign_shards(records, key, id_col, size, shards)
    done.repartition("shard", F.floor(F.col("slot") / FILE_ROWS)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
