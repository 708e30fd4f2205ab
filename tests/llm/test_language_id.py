import random

import numpy as np

from denialscope.llm import language_id as L

SYLLABLES = {"aa": ["ba", "lo", "mi", "ne"], "bb": ["sch", "eit", "ung", "ver"], "cc": ["ção", "ões", "que", "lh"]}


def text(lang, rng, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


def table(spark, n=60, seed=1):
    rng = random.Random(seed)
    rows = [(i, text(x, rng, rng.randint(3, 60)), x, "s") for i, x in enumerate(rng.choice(list(SYLLABLES)) for _ in range(n))]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_kernel_is_shared_ngrams():
    a, b = np.zeros(L.SLOTS, bool), np.zeros(L.SLOTS, bool)
    L.presence("abcab", a)
    L.presence("ABC", b)
    # a b c ab bc ca abc bca cab abca bcab; a b c ab bc abc
    assert a.sum() == 11 and b.sum() == 6 and (a & b).sum() == 6


def test_long_text_in_chunks(monkeypatch):
    rng = random.Random(3)
    t = text("aa", rng, 500)
    a, b = np.zeros(L.SLOTS, bool), np.zeros(L.SLOTS, bool)
    L.presence(t, a)
    monkeypatch.setattr(L, "CHUNK", 7)
    L.presence(t, b)
    assert (a == b).all()


def test_held_out_accuracy(spark):
    rows, df = table(spark, 200)
    model = L.train_language_id(df.where("doc_id < 120"), sample=90, landmarks=30)
    got = {r.doc_id: r for r in L.predict_language(df.select("doc_id", "text"), model).collect()}
    held = [r for r in rows if r[0] >= 120]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edge_rows(spark):
    rows, df = table(spark)
    model = L.train_language_id(df)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !? \n"), (None, "schung"), (4, "é"), (4, "é"), (5, "ba" * 100_000)], "doc_id long, text string")
    got = L.predict_language(odd, model).collect()
    assert len(got) == 7
    by = {r.doc_id: r for r in got}
    assert [(by[i].lang_pred, by[i].score) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert by[5].lang_pred == "aa" and by[4].lang_pred in SYLLABLES
    nothing = L.train_language_id(df.where("lang = 'zz'"))
    assert nothing is None
    assert {r.lang_pred for r in L.predict_language(odd, nothing).collect()} == {"und"}
    assert L.predict_language(odd.limit(0), model).count() == 0
