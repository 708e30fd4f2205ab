import hashlib
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from denialscope.llm import token_alignment as T
from denialscope.llm.registry import QUERIES


def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(rows):
    """The contract, token by token, with the tokenizers' own libraries."""
    a_lib, b_lib = libraries()
    to_byte = T.byte_characters()
    docs = []
    for i, t in rows:
        a = a_lib.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        b = b_lib.encode(t) if t else []
        ab = [bytes(to_byte[c] for c in a_lib.id_to_token(x)) for x in a]
        bb = [bytes([int(b_lib.id_to_piece(x)[3:-1], 16)]) if b_lib.is_byte(x) else b_lib.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if t and not (b"".join(ab) == b"".join(bb) == (" " + t).encode()):
            a, b, ab, bb = [], [], [], []
        spans = lambda bs: [(e - len(x), e) for x, e in zip(bs, np.cumsum([len(x) for x in bs]).tolist())]
        sa, sb = spans(ab), spans(bb)
        links = [(a[k], b[m]) for k, (s, e) in enumerate(sa) for m, (u, v) in enumerate(sb) if s < v and u < e]
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, low = [], 0
        for c in cuts:
            pick = lambda ids, ss: ",".join(str(x) for x, (_, e) in zip(ids, ss) if low < e <= c)
            groups.append(pick(a, sa) + "|" + pick(b, sb))
            low = c
        docs.append((i, a, b, links, ";".join(groups), len(groups)))
    count = Counter(p for d in docs for p in set(d[3]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(i, len(a), len(b), g, len(ls), sum(count[p] == best[p[0]] for p in ls), sum(count[p] for p in ls),
             hashlib.sha256(text.encode()).hexdigest() if a else "") for i, a, b, ls, text, g in docs]


def odd_texts():
    return [None, "", " ", "\n", "a", "  two  spaces ", "naïve façade – “quotes” 中文字 🙂👩‍👩‍👧 z", "<|endoftext|> <s> </s> <unk> <0x0A>", "tab\tand\r\nlines\n\n\n",
            "▁ mark", "x" * 700, "ab" * 300, "word " * 200, "\x00\x01", "é" * 90, " " * 5000, "don't we'll I'VE", "٣٤٥ ९८७", "áé", "ﬁ ﬂ ½ ²"]


def test_query_against_brute_force(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    words = "the of and to token tokens align alignment straße größer niño 中文 1234 fn(x) http://a.b/c?d=e".split()
    rows = list(enumerate(odd_texts()))
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += rows[-3:] + [(None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("block", F.lit(1)).withColumn("at", F.lit(2))
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_token_alignment"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(rows), key=key)


def test_small_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.length("text") < 1500).select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = T.token_alignment(docs)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows))


@pytest.mark.parametrize("lane", [1, 3, 256])
def test_lanes_give_the_same_links(lane):
    rng = np.random.default_rng(7)
    first_a, first_b, ends_a, ends_b, total = [0], [0], [], [], 0
    for n in (0, 1, 40, 900, 7):
        both = [np.sort(rng.choice(np.arange(1, 2 * n), n // 2 + (n > 1), replace=False)) if n > 1 else np.empty(0, int) for _ in range(2)]
        a, b = (np.unique(np.append(x, 2 * n)) if n else x for x in both)
        ends_a.extend((a + total).tolist()), ends_b.extend((b + total).tolist())
        total += 2 * n
        first_a.append(len(ends_a)), first_b.append(len(ends_b))
    ends_a, ends_b = np.array(ends_a, np.int64), np.array(ends_b, np.int64)
    la, lb, ca, cb = T.lockstep(ends_a, ends_b, np.array(first_a), np.array(first_b), lane)
    sa, sb = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
    want = {(i, j) for i in range(len(ends_a)) for j in range(len(ends_b)) if sa[i] < ends_b[j] and sb[j] < ends_a[i]}
    assert len(la) == len(want) and set(zip(la.tolist(), lb.tolist())) == want
    common = np.intersect1d(ends_a, ends_b)
    assert sorted(ends_a[ca].tolist()) == sorted(ends_b[cb].tolist()) == common.tolist()


def test_blocks_and_empty_tables(spark, monkeypatch):
    rows = [(i, f"some words {i % 3} " * (i % 5)) for i in range(60)]
    whole = sorted(tuple(r) for r in T.token_alignment(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert whole == sorted(brute(rows))
    named = spark.createDataFrame([(f"k{i}", t) for i, t in rows], "doc_id string, text string")
    assert sorted(r.doc_id for r in T.token_alignment(named).collect()) == sorted(f"k{i}" for i, _ in rows)
    assert T.token_alignment(named.limit(0)).count() == 0
    assert T.token_alignment(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).where("n_a = 0 and groups_sha256 = ''").count() == 2


def test_small_blocks_in_one_process(monkeypatch):
    """Blocks cut the documents at other places, not the result."""
    va, vb = T.vocabularies(T.BYTE_BPE, T.PIECES)
    texts = [t for t in odd_texts() if t] * 2
    whole = T.align(va, vb, *T.encode_pair(va, vb, texts))
    alone = [T.align(va, vb, *T.encode_pair(va, vb, [t])) for t in texts]
    assert whole["groups"] == [x["groups"][0] for x in alone]
    assert whole["n_links"].tolist() == [int(x["n_links"][0]) for x in alone]


def test_ranks_equal_the_library():
    """The quick encoder gives the file's own ids, at every code point."""
    enc = T.ByteBPE(public_tokenizers.path("byte_bpe_50k.json"))
    assert enc.fast is not None
    texts = [f" a{c}b {c}{c} 1{c}2 .{c}. {c}  {c}\n{c} \n a  {c}'s" for c in map(chr, [*range(0x3000), *range(0xA000, 0xD800, 97), *range(0xE000, 0x20000, 31)])]
    own = [e.ids for e in enc.own.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == own


def test_no_python_step_per_token():
    """Ten times the tokens take no more lines of Python, but for the encoders."""
    va, vb = T.vocabularies(T.BYTE_BPE, T.PIECES)

    def lines(text):
        count = 0

        def trace(frame, event, arg):
            nonlocal count
            if frame.f_code.co_filename != T.__file__:
                return None
            count += event == "line"
            return trace

        before = sys.gettrace()
        sys.settrace(trace)
        try:
            got = T.align(va, vb, *T.encode_pair(va, vb, [text]))
        finally:
            sys.settrace(before)
        return count, int(got["n_a"][0])

    (few, short), (more, long) = (lines("tokenizers align straße 中文 1234 fn(x) " * n) for n in (300, 3000))
    assert long > short + 10_000
    assert more - few < 1_000


def test_texts_that_do_not_come_back():
    """A text whose bytes one side changes has no tokens, its neighbours keep theirs."""
    va, vb = T.vocabularies(T.BYTE_BPE, T.PIECES)
    texts = ["plain words", "", None, "\u2581", "ab \u2581cd", "plain words", "  x  "]
    ids_a, ids_b, first_a, first_b = T.encode_pair(va, vb, texts)
    a_lib, b_lib = libraries()
    for k, t in enumerate(texts):
        a, b = ids_a[first_a[k]:first_a[k + 1]].tolist(), ids_b[first_b[k]:first_b[k + 1]].tolist()
        if t and "\u2581" not in t:
            assert a == a_lib.encode(" " + t, add_special_tokens=False).ids and b == b_lib.encode(t)
        else:
            assert a == b == []
