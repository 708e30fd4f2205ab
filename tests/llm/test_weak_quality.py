import collections
import random
import re

import numpy as np
from pyspark.sql import functions as F

from denialscope.llm.weak_quality import RULES, estimate, rule_votes, weak_quality

WORD = "[^\x20\x09-\x0D]+"


def brute(t):
    t = t or ""
    w = re.findall(WORD, t)
    c = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    return (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(hit))


def rows(df):
    q = F.col("_quality")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return {r.doc_id: r for r in weak_quality(df).select("doc_id", *[q[c].alias(c) for c in names + ("base_failed", "kept", "posterior")]).collect()}


def prose(rng, n):
    out = []
    while n > 0:
        k = min(n, rng.randint(4, 14))
        out.append(" ".join("".join(rng.choice(["er", "an", "th", "on", "ing", "re"]) for _ in range(rng.randint(1, 3))) + str(rng.randrange(9)) for _ in range(k)).capitalize() + ".")
        n -= k
    return "\n".join(out)


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \t\n\x0b\x0c\r", "a", "é ü x\ty", "a b c d e a b c d e", "a a a a a a", "x\nx\n\nx \nx", "😀 # | <b>", "a " * 3000,
             "a b c d e f\na b c d e f"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) + rng.choice(["", "\n", "\nq\nq"]) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    got = rows(df)
    for i, t in enumerate(texts):
        g, w = got[i], brute(t)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == w, t
        assert g.base_failed == (w[0] < 10 or 100 * w[4] > 20 * w[0])
        assert not (g.base_failed and g.kept)


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(4)
    good = [prose(rng, rng.randint(30, 300)) for _ in range(200)]
    junk = ["\n".join(" ".join(w + rng.choice(["###", "$$$", "***"]) for w in x.split()) for x in prose(rng, 80).split("\n")) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(good + junk)], "doc_id long, text string")
    got = rows(df)
    assert sum(got[i].kept for i in range(200)) >= 198
    assert sum(got[i].kept for i in range(200, 240)) <= 1
    clean = rows(df.where("doc_id < 200"))
    assert sum(r.kept for r in clean.values()) >= 198


def test_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert weak_quality(df).count() == 3
    assert weak_quality(df.limit(0)).count() == 0
    assert len(estimate({})[1]) == len(RULES)


def test_variety_of_very_long_texts(spark):
    """The bound on distinct words has no step at any length."""
    rng = random.Random(2)
    def salad(n, vocabulary):
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
    texts = [salad(19_000, 400), salad(21_000, 400), salad(60_000, 2_000), " ".join(f"v{k if k % 3 else k % 7}" for k in range(30_000))]
    got = weak_quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    votes = {r.doc_id: r["_quality"].votes[RULES.index("variety")] for r in got}
    assert votes == {0: -1, 1: -1, 2: -1, 3: 1}
    n, d = [19_990, 20_000, 20_010, 80_000, 80_000], [4_997, 5_000, 5_001, 9_999, 10_000]
    rows = spark.createDataFrame(list(zip(range(5), n, d)), "k int, n_words long, n_distinct long")
    zero = [F.lit(0).cast("long").alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_symbol_words", "n_lines", "n_ended", "n_upper", "n_exclaims")]
    f = rows.select("k", F.struct("n_words", "n_distinct", *zero).alias("f"))
    assert [r.v for r in f.select("k", rule_votes(F.col("f"))[RULES.index("variety")].alias("v")).orderBy("k").collect()] == [-1, 0, -1, -1, 0]


def plain_votes(t):
    """The nine rules once more, for ASCII texts."""
    w = re.findall(WORD, t)
    n, chars, symbols, dup, repeats = brute(t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    k = len(lines)
    upper, ended = len(re.findall("[A-Z]", t)), sum(bool(re.search(r"[.!?:;\")\]]\s*$", x)) for x in lines)
    marked, kinds = sum(bool(re.search(r"[#*$%&|<>]", x)) for x in w), len(set(w))
    few = 0.25 * min(n, (n * 20_000.0) ** 0.5)

    def vote(asked, bad, fine):
        return -1 if asked and bad else 1 if asked and fine else 0
    return (vote(n > 0, symbols > 0.1 * n, symbols <= 0.01 * n), vote(n > 0, marked > 0.1 * n, marked <= 0.01 * n),
            vote(n >= 20, upper > 0.2 * chars, upper < 0.1 * chars), vote(n >= 20, repeats > 0.1 * n, repeats <= 0.02 * n),
            vote(n >= 50, kinds < few, kinds > 0.45 * n), vote(k >= 4, dup > 0.3 * k, dup <= 0.1 * k),
            vote(k >= 2, ended < 0.4 * k, ended > 0.8 * k),
            vote(n >= 20, chars > 7 * n or chars < 2.5 * n, 3.5 * n <= chars <= 6.5 * n),
            vote(n >= 20, t.count("!") > 0.2 * n, t.count("!") < 0.05 * n))


def test_posterior_equals_estimation_over_single_documents(spark):
    rng = random.Random(9)
    texts = [prose(rng, rng.randint(5, 200)) for _ in range(120)]
    texts += ["\n".join(x + rng.choice([" ###", " !!!", " | |", ""]) for x in prose(rng, rng.randint(20, 120)).split("\n")) for _ in range(40)]
    texts += [prose(rng, 60).upper() for _ in range(10)] + ["\n".join([prose(rng, 9)] * 5) for _ in range(10)] + ["", "a b c"] + [texts[0]] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r["_quality"] for r in weak_quality(df).collect()}
    votes = np.array([plain_votes(t) for t in texts])
    assert [tuple(got[i].votes) for i in range(len(texts))] == [tuple(v) for v in votes]
    failed = np.array([got[i].base_failed for i in range(len(texts))])

    def posterior(v):
        fine = np.where(v == 1, right_good, np.where(v == -1, 1 - right_good, 1)).prod(axis=1) * share
        poor = np.where(v == -1, right_bad, np.where(v == 1, 1 - right_bad, 1)).prod(axis=1) * (1 - share)
        return fine / (fine + poor)

    share, right_good, right_bad = 0.8, np.full(len(RULES), 0.95), np.full(len(RULES), 0.4)
    learn = votes[~failed]
    for _ in range(200):
        p, before = posterior(learn), share
        share = (p.sum() + 0.8) / (len(learn) + 1)
        right_good = (p @ (learn == 1) + 0.95) / (p @ (learn != 0) + 1)
        right_bad = ((1 - p) @ (learn == -1) + 0.4) / ((1 - p) @ (learn != 0) + 1)
        if abs(share - before) < 1e-9:
            break
    want = posterior(votes)
    assert np.allclose([got[i].posterior for i in range(len(texts))], want, atol=1e-6)
    assert [got[i].kept for i in range(len(texts))] == [bool(not f and x >= 0.5) for f, x in zip(failed, want)]
    assert 0 < sum(got[i].kept for i in range(len(texts))) < len(texts) - failed.sum()
