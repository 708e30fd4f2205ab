import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from denialscope.llm import blocks
from denialscope.llm.lattice_lm import lattice_scores, tokens
from denialscope.llm.subword import Lattice, vocabulary

MODEL = "piece_bpe_32k.model"


def segmentations(vocab, word, ids):
    """All segmentations as lists of piece ids."""
    if not word:
        return [[]]
    out = []
    for k in range(1, len(word) + 1):
        head = word[:k]
        if head in ids:
            first = [ids[head]]
        elif k == 1:
            first = [int(vocab.bytes[b]) for b in head.encode()]
        else:
            continue
        out += [first + rest for rest in segmentations(vocab, word[k:], ids)]
    return out


def piece_ids():
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(MODEL)))
    return {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}


def test_forward_and_expected_equal_enumeration():
    vocab, ids = vocabulary(MODEL), piece_ids()
    rng = np.random.default_rng(1)
    log_p = np.log(rng.dirichlet(np.ones(vocab.size)) + 1e-12)
    words = ["the", "a", "nation", "x①", "日①②", "über", "ing", "the"]
    lattice = Lattice(vocab, log_p)
    got, use, want_use = lattice.log_probability(words), lattice.expected(words, np.arange(1.0, 9.0)), np.zeros(vocab.size)
    for w, c, g in zip(words, range(1, 9), got):
        segs = segmentations(vocab, "▁" + w, ids)
        p = np.array([sum(log_p[i] for i in s) for s in segs])
        total = np.logaddexp.reduce(p)
        assert math.isclose(g, total, rel_tol=1e-9)
        for s, x in zip(segs, p):
            for i in s:
                want_use[i] += c * math.exp(x - total)
    assert np.allclose(use, want_use, atol=1e-9)


def corpus(n, seed=3):
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choice(["an", "The", "ing", "é", "ou"]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)] + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "①" * 300 + " tail"), (n + 3, "again the"), (None, "no id")]


@pytest.mark.parametrize("block_rows", [1 << 14, 7])
def test_scores_equal_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", block_rows)
    rows = corpus(60)
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, word int")
    held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
    train = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7)) != 2
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score, r.lattice_score) for r in lattice_scores(df, train, rounds=0).collect()), key=str)
    c, ends = Counter(), 0
    for i, t in rows:
        if not held(i):
            c.update(tokens(t))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    once, twice = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
    d = min(0.95, max(0.1, once / (once + 2 * twice)))
    vocab = vocabulary(MODEL)
    lattice = Lattice(vocab, np.log(np.where(vocab.prior > 0, vocab.prior, 1e-300)))

    def word_score(w):
        p = d * len(c) / n * math.exp(lattice.log_probability([w.decode()])[0])
        return math.log10(p + max(c[w] - d, 0) / n) if p + max(c[w] - d, 0) > 0 else (math.log(d * len(c) / n) + lattice.log_probability([w.decode()])[0]) / math.log(10)

    want = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        want.append((i, len(w) + 1, sum(c[x] > 0 for x in w) + 1, n, base, sum(map(word_score, w)) + math.log10((ends - d) / n),
                     lattice.log_probability([x.decode() for x in w]).sum() / math.log(10) + len(w) * math.log10((n - ends) / n) + math.log10(ends / n)))
    want.sort(key=str)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda x: (str(x[0]), x[1])), sorted(want, key=lambda x: (str(x[0]), x[1]))):
        assert g[:4] == w[:4] and np.allclose(g[4:], w[4:], rtol=1e-8), (g, w)


def split_file(spark, rows, path):
    """``rows`` (doc_id, text) from a Parquet file of small row groups, of which
    every task reads one or two."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    ids, texts = zip(*rows)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())}), path, row_group_size=20)
    return spark.read.parquet(path)


def test_blocks_read_by_several_tasks_score_alike(spark, tmp_path, monkeypatch):
    rows = corpus(150, 8)
    train = F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True))
    want = lattice_scores(spark.createDataFrame(rows, "doc_id long, text string"), train).collect()
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = split_file(spark, rows, str(tmp_path / "split.parquet"))
        assert df.rdd.getNumPartitions() > 2
        got = lattice_scores(df, train).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    key = lambda r: (str(r.doc_id), r.n_tokens)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:4] == w[:4] and np.allclose(g[4:], w[4:], rtol=1e-9), (g, w)


def test_rounds_raise_held_out_probability_of_spelt_words(spark):
    df = spark.createDataFrame(corpus(200, 5), "doc_id long, text string")
    train = F.col("doc_id") % 2 == 0
    total = [lattice_scores(df, train, rounds=r).where("doc_id % 2 = 1 and doc_id < 200").agg(F.sum("score")).first()[0] for r in (0, 2)]
    assert total[1] > total[0]


def test_no_training_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in lattice_scores(df, F.lit(False)).collect()}
    assert got[1].n_tokens == 3 and got[1].n_known == 0 and got[1].train_tokens == 0
    assert got[1].base_score == 0 and got[1].score < got[2].score < 0 and got[1].lattice_score < got[2].lattice_score < 0
    assert lattice_scores(df.limit(0), F.lit(True)).count() == 0
