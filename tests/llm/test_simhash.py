import random

import numpy as np
import pytest
import xxhash

from denialscope.llm import simhash as S


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps):
    """component id by all pairs."""
    n = len(ids)
    par = list(range(n))

    def find(x):
        while par[x] != x:
            par[x] = par[par[x]]
            x = par[x]
        return x
    for i in range(n):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                par[find(i)] = find(j)
    best = {}
    for i in range(n):
        best[find(i)] = min(best.get(find(i), ids[i]), ids[i])
    return [best[find(i)] for i in range(n)]


def random_fps(n, rng):
    """Clusters, chains and lone values."""
    out = []
    while len(out) < n:
        v = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 5, 30])):
            out.append(v)
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
    return out[:n]


def test_fingerprint_matches_slow_form():
    rng = random.Random(5)
    texts = [None, "", " \n", "One", "a B", "a b c", "É é a"] + [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 200))) for _ in range(100)]
    assert [S.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


@pytest.mark.parametrize("n", [1, 63, 64, 65, 700])
def test_block_links_equal_all_pairs(n):
    fps = np.array(random_fps(n, random.Random(n)), np.uint64)
    root = S.link_block(fps, 3)
    want = brute_components(list(range(n)), [int(x) for x in fps])
    assert root.tolist() == want
    assert S.small_roots(fps, np.array([0]), np.array([n]), 3).tolist() == want if n <= 64 else True


def test_counters_count():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 300, dtype=np.uint64)
    y = x.copy()
    for k in range(300):
        for b in rng.choice(64, k % 9, replace=False):
            y[k] ^= np.uint64(1 << int(b))
    for radius in (0, 1, 2, 3, 4, 6):
        want = [bin(int(a ^ b)).count("1") <= radius for a, b in zip(x, y)]
        assert S.link_pairs(np.concatenate([x, y]), np.arange(300), np.arange(300) + 300, radius).tolist() == want


@pytest.mark.parametrize("limit", [S.BLOCK_LIMIT, 4])
def test_links_lose_nothing(spark, limit):
    """Also when every block of over 4 is split again and again."""
    rng = random.Random(9)
    fps = sorted(set(random_fps(400, rng)))
    centre = rng.getrandbits(64)
    fps = sorted(set(fps) | {centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)})
    df = spark.createDataFrame([(S.signed(f),) for f in fps], "fp long")
    got = {r.node: r.root for r in S.components(S.links(df, 3, limit)).collect()}
    order = sorted(fps, key=S.signed)
    want = brute_components([S.signed(f) for f in order], order)
    for f, w in zip(order, want):
        assert got.get(S.signed(f), S.signed(f)) == w


def test_documents(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choice(["al", "be", "ga", "de", "ep"]) + str(rng.randrange(50)) for _ in range(400)) for _ in range(6)]
    texts = [None, "", "  ", "tie", "TIE"] + base + base[:3] + [b.replace(b.split()[7], "edited", 1) for b in base]
    df = spark.createDataFrame([(100 - i, t, 1) for i, t in enumerate(texts)] + [(None, "tie", 1), (100, None, 2)], "doc_id long, text string, fp int")
    got = S.simhash_components(df).collect()
    assert len(got) == len(texts) + 2
    fps = [slow_fingerprint(t) for t in texts]
    want = dict(zip([100 - i for i in range(len(texts))], brute_components([100 - i for i in range(len(texts))], fps)))
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    assert [r.component_id for r in got if r.doc_id is None] == [want[97]]
    assert S.simhash_components(df.limit(0)).count() == 0
