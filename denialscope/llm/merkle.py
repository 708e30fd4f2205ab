"""Merkle manifest of a table, in DataFrame functions only.

Every row is a leaf: the SHA-256 of its fields, each written as its length and
value, so that no two rows run together. The leaves of a group (a source, say)
stand in the order of a column and are the lowest level of the group's tree;
``arity`` consecutive nodes make a parent, the last run as many as there are,
until one node is left, the group's subroot. The subroots, in the order of the
groups, are the leaves of the top tree, whose last node is the root.

1. Rows are numbered without gaps in each group: range-partitioned by (group,
   order, digest), numbered within partitions, and offset by the counts of the
   partitions before; a group that holds a third of all rows spreads over as
   many partitions as its rows fill.
2. A level is an equi-join of the nodes with themselves for each sibling: its
   index is the node's own with the lowest bit flipped (arity two) or in
   another slot of the same run (else). Every node then has what stands left
   and right of it in its run, and the rows in slot zero emit the parents.
   Keys are (group, index), so a large group is no hot key.
3. Proofs go down again: a node's path is what stands beside it, followed by
   its parent's path. What all leaves below a node share is joined to them one
   level at a time.

Each level is written to the shared folder; a lost executor costs the running
level. The driver knows the number of levels and the root and nothing else.

Null fields are ``-``, so null and empty texts differ; null groups and orders
come first. Rows that are equal in every field are leaves of their own, next
to each other; which of them comes first makes no difference. An empty table
has no root. Columns not named take no part, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ARITY = 3


def _none() -> Column:
    return F.expr("X''")


def digest(data: Column) -> Column:
    """SHA-256 (32 bytes) of a string's UTF-8 bytes."""
    return F.unhex(F.sha2(data.cast("binary"), 256))


def as_text(h: Column) -> Column:
    """Digests as the trees hash them: lowercase hexadecimal text."""
    return F.lower(F.hex(h))


def parent_digest(left: Column, h: Column, right: Column) -> Column:
    return digest(as_text(F.concat(left, h, right)))


def record_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: for each field ``-`` if null, else the number of its
    UTF-8 bytes, a colon and its text."""
    def one(c):
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(F.concat(*[one(c) for c in fields]))


def _group_key(c: Column) -> Column:
    """A string that tells all groups apart, null among them."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows(grp, ord, h, row)`` with ``g``, a gapless ``idx`` from 0 in each
    group, and ``n``, the rows of the group; written once."""
    # A last key tells repeated rows apart, so that a row repeated very often
    # spreads over partitions too.
    told = rows.withColumn("u", F.monotonically_increasing_id())
    spread = told.repartitionByRange("grp", "ord", "h", "u").sortWithinPartitions("grp", "ord", "h", "u")
    place = F.monotonically_increasing_id()
    at = written(spread.select(_group_key(F.col("grp")).alias("g"), "grp", "ord", "h", "row", place.alias("at")), "merkle-order")
    at = at.withColumn("part", F.shiftright("at", 33))
    counts = at.groupBy("g", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("g", "part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("off"),
                            F.sum("c").over(whole).alias("n"))
    return at.join(offsets, ["g", "part"]).select("g", (F.col("at") + F.col("off")).alias("idx"), "n", "h", "grp", "row")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes(g, idx, n, h, ...)`` with ``l`` and ``r``: the digests left and
    right of each node in its run, joined end to end."""
    slot = F.pmod(F.col("idx"), F.lit(arity))
    out = nodes
    for shift in range(1, arity):
        if arity == 2:
            other = F.col("idx").bitwiseXOR(F.lit(1))
        else:
            other = F.col("idx") - slot + F.pmod(slot + shift, F.lit(arity))
        beside = nodes.select("g", F.col("idx").alias(f"i{shift}"), F.col("h").alias(f"h{shift}"))
        out = out.withColumn(f"i{shift}", other).join(beside, ["g", f"i{shift}"], "left")

    def side(own: int, slots: range) -> Column:
        found = [F.coalesce(F.col(f"h{(j - own) % arity}"), _none()) for j in slots]
        return F.concat(_none(), *found)
    left, right = _none(), _none()
    for own in range(arity):
        left = F.when(slot == own, side(own, range(own))).otherwise(left)
        right = F.when(slot == own, side(own, range(own + 1, arity))).otherwise(right)
    return out.select(*nodes.columns, left.alias("l"), right.alias("r"))


@dataclass
class Tree:
    """Trees of any number of groups. ``levels[k]``: (g, idx, n, h, l, r) of
    the nodes that have a parent, leaves first; ``roots``: (g, level, h)."""

    levels: list[DataFrame]
    roots: DataFrame
    arity: int


def build(leaves: DataFrame, arity: int = ARITY) -> Tree:
    """Trees over ``leaves(g, idx, n, h)``; further columns stay with the
    leaves."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, nodes = [], leaves
    roots = leaves.where(F.col("n") == 1).select("g", F.lit(0).alias("level"), "h")
    while most > 1:
        inner = written(with_siblings(nodes.where(F.col("n") > 1), arity), "merkle-level")
        levels.append(inner)
        nodes = inner.where(F.pmod(F.col("idx"), F.lit(arity)) == 0).select(
            "g", F.expr(f"idx div {arity}").alias("idx"), F.ceil(F.col("n") / arity).alias("n"),
            parent_digest(F.col("l"), F.col("h"), F.col("r")).alias("h"))
        roots = roots.unionByName(nodes.where(F.col("n") == 1).select("g", F.lit(len(levels)).alias("level"), "h"))
        most = -(-most // arity)
    return Tree(levels, written(roots, "merkle-roots"), arity)


def paths(tree: Tree, above: DataFrame) -> list[DataFrame]:
    """For every level, (g, idx, path, top) of the nodes in it, given
    ``above(g, path, top)`` of the roots. A path lists (l, r) upwards."""
    ends = tree.roots.join(above, "g").select("g", "level", F.lit(0).cast("long").alias("idx"), "path", "top")
    found = [ends.where(F.col("level") == len(tree.levels)).drop("level")]
    for k in reversed(range(len(tree.levels))):
        up = found[0].select("g", F.col("idx").alias("up"), F.col("path").alias("rest"), "top")
        own = tree.levels[k].withColumn("up", F.expr(f"idx div {tree.arity}")).join(up, ["g", "up"]).select(
            "g", "idx", F.concat(F.array(F.struct("l", "r")), "rest").alias("path"), "top")
        here = own.unionByName(ends.where(F.col("level") == k).drop("level"))
        found.insert(0, written(here, "merkle-paths") if k else here)
    return found


@dataclass
class Manifest:
    """``leaves``: (g, idx, n, h, grp, row), ``subroots``: (g, idx, n, h, grp)
    in the order of the groups, ``root``: hexadecimal, None of no rows."""

    leaves: DataFrame
    groups: Tree
    subroots: DataFrame
    top: Tree
    root: str | None


def merkle_manifest(rows: DataFrame, fields: Sequence[str | Column], group: str, order: str,
                    keep: Sequence[str | Column] = (), arity: int = ARITY) -> Manifest:
    """Manifest of ``rows``. ``keep`` are columns that stay with the leaves (in
    the struct ``row``), for proofs."""
    col = lambda c: F.col(f"`{c}`") if isinstance(c, str) else c
    kept = [col(c) for c in keep] or [F.lit(None).cast("string").alias("none")]
    start = rows.select(col(group).alias("grp"), col(order).alias("ord"), record_digest([col(c) for c in fields]).alias("h"), F.struct(*kept).alias("row"))
    leaves = written(numbered(start), "merkle-leaves")
    groups = build(leaves.drop("grp", "row"), arity)
    names = leaves.where(F.col("idx") == 0).select("g", "grp")
    tops = groups.roots.join(names, "g").select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("ord"), "h", F.struct("g").alias("row"))
    subroots = written(numbered(tops), "merkle-subroots")
    top = build(subroots.drop("grp", "row"), arity)
    root = top.roots.select(as_text(F.col("h"))).first()
    return Manifest(leaves, groups, subroots, top, root[0] if root else None)


def proofs(m: Manifest) -> DataFrame:
    """(row, h, path, subroot): every leaf with its siblings up to the root."""
    spark = m.leaves.sparkSession
    none = spark.createDataFrame([], "g string, path array<struct<l: binary, r: binary>>, top binary")
    empty = m.top.roots.select("g", F.from_json(F.lit("[]"), "array<struct<l: binary, r: binary>>").alias("path"), F.col("h").alias("top"))
    over = paths(m.top, empty)[0] if m.root else none.withColumn("idx", F.lit(0).cast("long"))
    of_groups = m.subroots.select("idx", F.col("row.g").alias("gg"), "h").join(over.select("idx", "path"), "idx").select(F.col("gg").alias("g"), "path", F.col("h").alias("top"))
    found = paths(m.groups, written(of_groups, "merkle-tops"))[0]
    return m.leaves.select("g", "idx", "h", "row").join(found, ["g", "idx"]).select("row", "h", "path", F.col("top").alias("subroot"))


def folded(h: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, h, lambda acc, s: parent_digest(s["l"], acc, s["r"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, upwards, from left to right."""
    return digest(as_text(F.aggregate(path, _none(), lambda acc, s: F.concat(acc, s["l"], s["r"]))))


def verified(found: DataFrame, root: str | None, claimed: str | Column = "h") -> DataFrame:
    """``found`` (of ``proofs``) with ``folded_root``, recomputed from the
    ``claimed`` digests, and whether it is ``root``."""
    got = as_text(folded(F.col(claimed) if isinstance(claimed, str) else claimed, F.col("path")))
    return found.withColumn("folded_root", got).withColumn("verified", F.col("folded_root") == F.lit(root))
