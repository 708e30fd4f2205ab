import itertools
import random

import numpy as np

from denialscope.llm import line_crf as C


def brute(node, trans, size):
    """Marginals of one chain by summing over all label sequences."""
    total, good = 0.0, np.zeros(size)
    pairs = np.zeros((2, 2))
    for ys in itertools.product((0, 1), repeat=size):
        s = np.exp(sum(node[t] * y for t, y in enumerate(ys)) + sum(trans[a, b] for a, b in zip(ys, ys[1:])))
        total += s
        good += s * np.array(ys)
        for a, b in zip(ys, ys[1:]):
            pairs[a, b] += s
    return good / total, pairs / total, np.log(total)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    sizes = np.array([1, 5, 3, 1, 7, 3])
    node, trans = rng.normal(0, 2, sizes.sum()), rng.normal(0, 1, (2, 2))
    p, pairs, logz = C.Chains(sizes).marginals(node, trans)
    want_p, want_pairs, want_z, at = [], np.zeros((2, 2)), 0.0, 0
    for n in sizes:
        a, b, c = brute(node[at:at + n], trans, n)
        want_p += a.tolist()
        want_pairs += b
        want_z += c
        at += n
    assert np.allclose(p, want_p) and np.allclose(pairs, want_pairs) and np.isclose(logz, want_z)


def good(rng):
    return "\n".join("".join(rng.choice("abcde") for _ in range(4)).capitalize() + " " + " ".join(rng.choice(["the", "of", "in", "word", "text"]) for _ in range(9)) + "." for _ in range(rng.randint(1, 9)))


def junk(rng):
    return "\n".join(" | ".join(rng.choice(["x", "menu", "LOGIN"]) + "###" for _ in range(6)) for _ in range(rng.randint(1, 9)))


def test_held_out_quality(spark):
    rng = random.Random(1)
    rows = [(i, good(rng) if i % 4 else junk(rng), int(i % 4 > 0)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = df.select("doc_id", "quality")
    model = C.train_line_crf(df.drop("quality"), labels.where("doc_id < 160"))
    got = {r.doc_id: r.score for r in C.line_quality(df, model).collect()}
    assert sum((got[i] >= 0.3) == bool(q) for i, _, q in rows if i >= 160) >= 78
    few = C.train_line_crf(df, labels, sample=40, sample_lines=60)
    assert few is not None


def test_edge_rows(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, good(rng) if i % 2 else junk(rng), i % 2) for i in range(20)] + [(99, None, 1), (98, "", 0), (97, "x", None)],
                               "doc_id long, text string, quality int")
    model = C.train_line_crf(df, df.select("doc_id", "quality"))
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "\n \n"), (3, "a\n" * 20_000), (3, "a"), (3, "a")], "doc_id long, text string")
    got = C.line_quality(odd, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert C.line_quality(odd.limit(0), model).count() == 0
    none = C.train_line_crf(df, df.where("quality = 7").select("doc_id", "quality"))
    assert none is None and {r.score for r in C.line_quality(odd, none).collect()} == {0.5}


def test_one_very_long_document_leaves_the_sample_to_the_others(spark):
    rng = random.Random(3)
    rows = [(i, good(rng) if i % 2 else junk(rng), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows + [(100, "x ###\n" * 30_000, 0)], "doc_id long, text string, quality int")
    labels = df.select("doc_id", "quality")
    most = sum(t.count("\n") + 1 for _, t, _ in rows)
    with_long, without = (C.train_line_crf(df, known, sample_lines=most) for known in (labels, labels.where("doc_id < 100")))
    assert all(np.array_equal(with_long[k], without[k]) for k in with_long)
    assert C.train_line_crf(df, labels.where("doc_id = 100"), sample_lines=most) is None
    # the documents that fit, by a count of one's own
    for bound in (1, 5, most // 3):
        part = C.train_line_crf(df, labels.where("doc_id < 100"), sample_lines=bound)
        assert part is None or part["weights"].shape == (C.WIDTH,)


def test_whole_scores_equal_a_sum_over_labellings(spark):
    rng = random.Random(5)
    texts = [good(rng) if i % 2 else junk(rng) for i in range(30)] + [None, "", "\n\n", "one line", "a b\na b\na b"]
    df = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "doc_id long, text string, quality int")
    model = C.train_line_crf(df, df.select("doc_id", "quality"))
    got = {r.doc_id: r.score for r in C.line_quality(df, model).collect()}
    for i, t in enumerate(texts):
        x, size = C.line_features(t)
        p, _, _ = brute(((x - model["mean"]) / model["dev"]) @ model["weights"], model["trans"], len(size))
        weight = np.maximum(size, 1)
        assert np.isclose(got[i], (p * weight).sum() / weight.sum(), atol=1e-9), t
