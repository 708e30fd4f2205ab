import random

import pytest

from denialscope.llm import blocks
from denialscope.llm import piece_lattice as L


def brute(p, text):
    """Viterbi over the whole text; of equal sums the longer last piece."""
    if not text:
        return []
    s = "▁" + text.replace(" ", "▁")
    table = {a: (i, x) for a, i, x in p.rows}
    best = [(0.0, None, None)]
    for e in range(1, len(s) + 1):
        top = None
        for b in range(max(0, e - p.longest), e):
            sub = s[b:e]
            if sub in table:
                i, x = table[sub]
                got = (best[b][0] + x, b, [i])
            elif e - b == 1:
                got = (best[b][0] + p.unknown, b, [p.first_byte + v for v in sub.encode()])
            else:
                continue
            if top is None or got[0] > top[0]:
                top = got
        best.append(top)
    out, e = [], len(s)
    while e:
        _, b, ids = best[e]
        out[:0] = ids
        e = b
    return out


def sample():
    rng = random.Random(4)
    alphabet = "   \n\tthe an ing é①ñ.,!?()<s>0x41▁AB"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    texts += [" ".join(rng.choice(["thousand", "Über", "nation,", "x=1;", "日本", "ing"]) for _ in range(rng.randint(0, 40))) for _ in range(40)]
    return texts + [None, "", " ", "\n", "  two  spaces ", "a" * 200, "\x00", "tie tie"]


@pytest.mark.parametrize("block_rows", [1 << 14, 9])
def test_ids_equal_viterbi_over_whole_texts(spark, monkeypatch, block_rows):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", block_rows)
    texts = sample()
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)] + [(None, "null id", 0), (3, texts[3], 0)], "doc_id long, text string, ids int")
    p = L.pieces(L.TOKENIZER)
    got = L.encode_documents(df)
    rows = got.collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        t = "null id" if r.doc_id is None else texts[r.doc_id]
        assert list(r.ids) == brute(p, t), t
        assert r.n_pieces == len(r.ids) and r.round_trip
    back = {r.doc_id: r.text for r in L.decode_documents(got).collect()}
    for i, t in enumerate(texts):
        assert back[i] == (t or "").replace("▁", " ")


def test_long_words_are_split_without_loss(spark):
    text = "ab" * 5000 + " end"
    r = L.encode_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.round_trip and L.pieces(L.TOKENIZER).decode(r.ids) == text


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.encode_documents(df).count() == 0


def test_words_over_the_bound_equal_viterbi_over_whole_texts(spark):
    rng = random.Random(12)
    letters = "etaoinshrdlucmfw"
    runs = ["".join(rng.choice(letters) for _ in range(n)) for n in (256, 257, 300, 511, 513, 2_000, 2_000, 2_000, 10_000)]
    texts = runs + ["ab" * 5000, "information" * 200, "x" + "日本" * 400 + "é" * 300, "short words, then " + "internationalization" * 60 + " and the end"]
    p = L.pieces(L.TOKENIZER)
    assert any(len(w) > L.MAX_WORD for t in texts for w in p.words(t))
    got = L.encode_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for r in got.collect():
        assert list(r.ids) == brute(p, texts[r.doc_id]) and r.round_trip, texts[r.doc_id][:40]


def test_both_folds_agree():
    """A word's path is the same whichever side of the bound it is on."""
    p = L.pieces(L.TOKENIZER)
    for text in sample():
        got = [i for w in p.words(text) for i in p.best_path(w)]
        assert got == brute(p, text), text
