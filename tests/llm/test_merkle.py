import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from denialscope.llm import merkle as M
from denialscope.llm.registry import QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))


def tree(nodes, arity):
    """Root, and the siblings of every leaf, level by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = a // arity * arity
            proofs[i].append((nodes[run:a], nodes[a + 1:run + arity]))
        nodes = [H("".join(nodes[k:k + arity])) for k in range(0, len(nodes), arity)]
        at = [a // arity for a in at]
    return (nodes[0] if nodes else None), proofs


def fold(h, proof):
    for left, right in proof:
        h = H("".join(left) + h + "".join(right))
    return h


def brute(rows, arity=3):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    own, subroots = [], []
    for s in names:
        rs = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        sub, proofs = tree([leaf(r) for r in rs], arity)
        subroots.append(sub)
        own.append((rs, proofs, sub))
    root, tops = tree(subroots, arity)
    out = []
    for (rs, proofs, sub), top in zip(own, tops):
        for r, p in zip(rs, proofs):
            whole = p + top
            bad = r
            if zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 2 == 0 and r[4] is not None:
                bad = (*r[:4], r[4].replace("\n", ""))
            got = fold(leaf(bad), whole)
            out.append((r[0], leaf(r), sub, root, H("".join("".join(a) + "".join(b) for a, b in whole)), got, got == root))
    return out


def rows_of(rng, n, sources):
    out = []
    for i in range(n):
        text = rng.choice([None, "", "one\ntwo", "ü" * rng.randint(0, 5), "line\n" * rng.randint(1, 4), "x" * rng.randint(0, 40)])
        out.append((i * 7 % 1009, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i]), text))
    return out


@pytest.mark.parametrize("seed,n,sources", [
    (1, 400, ["a", "a", "a", "a", "a", "b", "", None, "é", "z"]),
    (2, 60, [f"s{k}" for k in range(40)]),
    (3, 1, ["only"]),
    (4, 28, [None]),
])
def test_query_against_brute_force(spark, tmp_path, seed, n, sources):
    rows = rows_of(random.Random(seed), n, sources)
    rows += rows[:3] * 4  # repeated rows
    spark.createDataFrame(rows, SCHEMA).withColumn("g", F.lit(1)).withColumn("h", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_merkle_manifest"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_trees_of_every_size(spark, arity):
    rows = [(i, f"{n:02d}", None, None, str(i)) for n in (1, 2, 3, 4, 5, 8, 9, 10, 27, 28) for i in range(n)]
    m = M.merkle_manifest(spark.createDataFrame(rows, SCHEMA), FIELDS, "source", "doc_id", keep=["source", "doc_id"], arity=arity)
    want = {r[1]: r for r in []}
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(leaf(r))
    want = {s: tree(hs, arity)[0] for s, hs in by.items()}
    assert m.root == tree([want[s] for s in sorted(want)], arity)[0]
    got = M.verified(M.proofs(m), m.root).select("row.source", M.as_text(F.col("subroot")).alias("s"), "verified").collect()
    assert len(got) == len(rows) and all(r.verified and r.s == want[r.source] for r in got)


def test_numbers_are_gapless_over_partitions(spark):
    df = spark.range(5000).select(F.lit("hot").alias("grp"), F.col("id").alias("ord"), M.digest(F.lit("same")).alias("h"), F.struct("id").alias("row"))
    got = M.numbered(df.repartition(7)).select("idx", "n", "row.id").collect()
    assert sorted(r.idx for r in got) == list(range(5000)) and all(r.idx == r.id and r.n == 5000 for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    m = M.merkle_manifest(df, FIELDS, "source", "doc_id")
    assert m.root is None and M.proofs(m).count() == 0


def test_any_changed_field_is_found(spark):
    rows = [(i, "s", "en", 3, f"text {i}") for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    m = M.merkle_manifest(df, FIELDS, "source", "doc_id", keep=FIELDS)
    found = M.proofs(m)
    for c, v in (("doc_id", F.lit(99)), ("source", F.lit(None)), ("lang", F.lit("")), ("n_chars", F.lit(4)), ("text", F.lit("text"))):
        claimed = M.record_digest([v if f == c else F.col(f"row.{f}") for f in FIELDS])
        assert M.verified(found, m.root, claimed).where("verified").count() == 0
    assert M.verified(found, m.root).where("verified").count() == 10
