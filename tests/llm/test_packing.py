import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from denialscope.llm import packing as P


def slow_best_fit(lengths, size):
    rows, free = [], []
    for p in sorted(range(len(lengths)), key=lambda p: (-lengths[p], p)):
        fits = [f for f in free if f >= lengths[p]]
        if fits:
            k = free.index(min(fits))
        else:
            k = len(rows)
            rows.append([])
            free.append(size)
        rows[k].append(p)
        free[k] -= lengths[p]
    return sorted(free)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40).flatmap(lambda s: st.tuples(st.just(s), st.lists(st.integers(1, s), max_size=80))))
def test_best_fit_equals_scan(case):
    size, lengths = case
    rows = P.best_fit(lengths, size)
    assert sorted(p for r in rows for p in r) == list(range(len(lengths)))
    assert sorted(size - sum(lengths[p] for p in r) for r in rows) == slow_best_fit(lengths, size)


def test_round_trip(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "béta", "γ", "delta!"]) for _ in range(rng.randint(0, 150))) for _ in range(80)]
    texts += [None, "", "x" * 4000, texts[0]]
    df = spark.createDataFrame([(i, t, b"") for i, t in enumerate(texts)] + [(None, "n", b"")], "doc_id long, text string, ids binary")
    size = 64
    rows = P.pack_documents(df, size=size, group_tokens=500).collect()
    ids, pos = P.matrix([r.ids for r in rows], size), P.matrix([r.positions for r in rows], size)
    assert len({r.row_id for r in rows}) == len(rows)
    found = {}
    for k, r in enumerate(rows):
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= size
        assert (ids[k, r.n_tokens:] == P.PAD).all()
        for d, off, a, b in zip(r.doc_ids, r.offsets, r.cu_seqlens, r.cu_seqlens[1:]):
            assert pos[k, a:b].tolist() == list(range(b - a))
            found.setdefault(d, {})[off] = ids[k, a:b].tolist()
    enc = P.encoding(P.TOKENIZER)
    for d, t in [*enumerate(texts), (None, "n")]:
        whole = [x for _, part in sorted(found[d].items()) for x in part]
        assert whole == enc.encode_ordinary(t or "") + [P.END]
        assert enc.decode(whole[:-1]) == (t or "")
    assert P.pack_documents(df.limit(0), size=size).count() == 0


def test_written(spark, tmp_path):
    df = spark.createDataFrame([(i, "some words here") for i in range(20)], "doc_id long, text string")
    P.write_packed(df, str(tmp_path / "p"), size=32)
    back = spark.read.parquet(str(tmp_path / "p")).collect()
    assert P.matrix([r.ids for r in back], 32).shape == (len(back), 32)
    assert sorted(d for r in back for d in r.doc_ids) == list(range(20))
    assert isinstance(P.matrix([back[0].positions], 32)[0, 0], np.uint16)
