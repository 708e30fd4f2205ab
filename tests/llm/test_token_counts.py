import random

import public_tokenizers
import sentencepiece

from denialscope.llm.token_counts import MergeCounter, counter, token_counts


def library():
    return sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))


def test_counts_equal_the_library(spark):
    random.seed(3)
    alphabet = " \n\t▁aébĀﬁ①thein,.<s>0x41\x00日本"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 80))) for _ in range(500)]
    texts += ["", " ", "  ", "▁", "a ", "<s>", "\n", "x" * 5000, " ".join(["word"] * 3000), None, "tie tie tie"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in token_counts(df).collect()}
    sp = library()
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].n_tokens == len(sp.encode(t or "")), t
        assert got[i].n_bytes == len((t or "").encode())


def test_cache_is_bounded(monkeypatch):
    from denialscope.llm import token_counts as m
    monkeypatch.setattr(m, "CACHE_WORDS", 10)
    c = MergeCounter(str(public_tokenizers.path("piece_bpe_32k.model")))
    text = " ".join(f"w{i}" for i in range(100))
    assert c.count(text) == counter("piece_bpe_32k.model").count(text)
    assert len(c) <= 10


def test_empty_table_nulls_and_repeats(spark):
    df = spark.createDataFrame([(None, None), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in token_counts(df).collect()) == [(0, 0, 0), (1, 3, 2), (1, 3, 2)]
    assert token_counts(df.limit(0)).count() == 0
