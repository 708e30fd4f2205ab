import random

import numpy as np

from denialscope.llm import decontaminate as D

WORDS = [a + b + c for a in ("ba", "to", "ri", "mu") for b in ("ne", "lo", "sa", "ki") for c in ("", "x", "ly", "ed", "th")] + ["the", "of", "and"] * 10


def brute_align(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_full_table():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 20)), rng.integers(-1, 5, rng.integers(0, 40))
        assert D.align(a, b)[0] == brute_align(a.tolist(), b.tolist())


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(t, rng, share):
    out = []
    for w in t.split():
        x = rng.random()
        if x < share / 3:
            continue
        out.append(w.upper() + "," if x > share else "edit" + str(rng.randrange(99)))
        if share > x > 2 * share / 3:
            out.append(w)
    return " ".join(out)


def test_finds_exact_and_edited_and_nothing_else(spark):
    rng = random.Random(7)
    items = [(i, text(rng, rng.randint(12, 50))) for i in range(30)] + [(98, None), (99, "too short")]
    docs, want = [], set()
    for d in range(300):
        parts = [text(rng, rng.randint(0, 200)) for _ in range(2)]
        if d % 6 == 0:
            i = rng.randrange(30)
            parts.insert(1, items[i][1] if d % 12 else edited(items[i][1], rng, 0.25))
            want.add((d, i))
        docs.append((d, "\n".join(parts), d))
    docs += [(900, None, 0), (901, "", 0), (None, items[3][1], 0), (6, docs[6][1], 0), (902, items[5][1] + " filler" * 30_000, 1)]
    want |= {(None, 3), (902, 5)}
    df = spark.createDataFrame(docs, "doc_id long, text string, score int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert sum(r.doc_id == 6 for r in got) == 2
    for r in got:
        if r.doc_id == 902:
            assert (r.first_word, r.last_word) == (0, len(items[5][1].split()) - 1) and r.score == 1
    kept = D.decontaminate(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == sorted((d is None, d) for d, *_ in docs if not any(d == x for x, _ in want))


def test_blocks_of_items(spark, monkeypatch):
    """A benchmark over the bound of a block is met block by block."""
    monkeypatch.setattr(D, "BLOCK_BYTES", 200)
    rng = random.Random(3)
    items = [(i, text(rng, 20)) for i in range(8)]
    df = spark.createDataFrame([(i, t) for i, t in items] + [(50, text(rng, 40))], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect()} == {(i, i) for i in range(8)}
    assert [r.doc_id for r in D.decontaminate(df, bench).collect()] == [50]


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert D.contaminated(df, bench).count() == 1
    assert D.contaminated(df.limit(0), bench).count() == 0
    assert D.contaminated(df, bench.limit(0)).count() == 0
    assert D.decontaminate(df, bench.limit(0)).count() == 1


def test_periodic_edits_are_found(spark):
    """Copies whose intact runs are as short as the threshold allows."""
    rng = random.Random(5)
    rare = [f"w{k}" for k in range(400)]
    items = [(i, " ".join(rng.choice(rare) for _ in range(rng.randint(15, 59)))) for i in range(40)]
    docs = []
    for i, t in items:
        w = t.split()
        for every in (3, 4, 5):
            start = rng.randrange(every)
            docs.append((i, " ".join(x if k % every != start else f"new{k}" for k, x in enumerate(w))))
        docs.append((i, " ".join(x for k, v in enumerate(w) for x in ((v, "added") if k % 2 else (v,)))))
        docs.append((i, " ".join(x for v in w for x in (v, "added"))))
        docs.append((i, " ".join(x for k, x in enumerate(w) if k % 4)))
    rows = [(n, "before " * rng.randint(0, 30) + t + " after" * rng.randint(0, 30)) for n, (_, t) in enumerate(docs)]
    got = D.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(n, i) for n, (i, _) in enumerate(docs)} == {(r.doc_id, r.item_id) for r in got}


def test_seeds_lose_nothing_over_the_threshold():
    """Random edits of every kind against alignments of whole documents."""
    rng = random.Random(6)
    some = WORDS[:40]
    items = D.Items([(i, " ".join(rng.choice(some) for _ in range(rng.randint(6, 40)))) for i in range(30)])
    texts = []
    for _ in range(300):
        w = [list(items.vocab)[x].decode() for x in items.words[rng.randrange(30)]]
        share = rng.choice([0.1, 0.25, 0.4, 0.55])
        w = [x for v in w for x in rng.choice([["zz"], [], [v, "zz"], [v, "zz", "zz"]] if rng.random() < share else [[v]])]
        texts.append(" ".join(["yy"] * rng.randint(0, 9) + w + [rng.choice(some) for _ in range(rng.randint(0, 9))]))
    counts = np.zeros(len(items.grams), np.int64)
    for t in texts:
        key, _ = items.pairs(items.numbers(t))
        np.add.at(counts, np.searchsorted(items.grams, key[np.isin(key, items.grams)]), 1)
    items.choose_seeds(counts)
    over = 0
    for t in texts:
        doc = items.numbers(t)
        best = [D.align(w, doc) for w in items.words]
        want = {i: s for i, (s, _, n) in enumerate(best) if s >= items.least[i] and n >= min(items.size[i], D.LEAST_WORDS)}
        got = items.found(t)
        assert {i: round(x[0] * 2 * len(items.words[i])) for i, x in got.items()} == want
        over += len(want)
    assert over > 150


def test_parts_of_long_documents_lose_nothing(monkeypatch):
    """Seed hits are held part by part; what lies over a cut is found."""
    rng = random.Random(11)
    some = WORDS[:50]
    items = D.Items([(i, " ".join(rng.choice(some) for _ in range(rng.randint(2, 45)))) for i in range(25)])
    names = list(items.vocab)
    docs = []
    for _ in range(25):
        out = []
        while len(out) < 1_500:
            w = [names[x].decode() for x in items.words[rng.randrange(25)]]
            out += [x for v in w for x in rng.choice([[v, "zz"], []] if rng.random() < 0.15 else [[v]])]
            out += [rng.choice(some + ["yy"] * 50) for _ in range(rng.randint(0, 400))]
        docs.append(" ".join(out))
    items.choose_seeds(np.ones(len(items.grams), np.int64))
    over = 0
    for t in docs:
        doc = items.numbers(t)
        monkeypatch.setattr(D, "PART_WORDS", 1)
        parts = items.found(t)
        monkeypatch.setattr(D, "PART_WORDS", 1 << 40)
        whole = items.found(t)
        best = [D.align(w, doc) for w in items.words]
        want = {i: s for i, (s, _, n) in enumerate(best) if s >= items.least[i] and n >= min(items.size[i], D.LEAST_WORDS)}
        assert {i: round(x[0] * 2 * len(items.words[i])) for i, x in parts.items()} == want
        assert {i: x[0] for i, x in parts.items()} == {i: x[0] for i, x in whole.items()}
        over += len(want)
    assert over > 60
    assert items.found(" ".join(["yy"] * 3_000)) == {} and items.found(None) == {}


def test_short_items_and_scripts_without_spaces(spark):
    rng = random.Random(9)
    items = [(1, "Ohm's law?"), (2, "Ångström"), (3, "who wrote Faust"), (4, "中国的首都是哪个城市？请回答。"), (5, "ประเทศไทยมีเมืองหลวงชื่ออะไร"),
             (6, "日本で一番高い山は、何ですか。"), (7, "«Où» — “est” la… bibliothèque"), (8, "!?"), (9, "首都")]
    have = {1: "by ohm s LAW it", 2: "one Ångström is", 3: "Who wrote “Faust”?", 5: "ถาม ประเทศไทยมีเมืองหลวงชื่ออะไร ครับ",
            6: "問題:日本で一番高い山は何ですか", 7: "où est la bibliothèque"}
    docs = [(i, text(rng, 30) + " " + t + " " + text(rng, 30)) for i, t in have.items()]
    docs += [(40, "他说：“中国的首都是哪一个城市？请回答”。"), (90, "ohm law s"), (91, "who never wrote Faust"), (92, "首 and 都 far"), (93, "今天天气很好，我们去公园玩。"), (94, "山が好きです")]
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(i, i) for i in have} | {(40, 4), (40, 9)}
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.score == 1 for r in got if r.item_id in (1, 2, 3, 9))


def test_short_items_do_not_condemn_common_phrases(spark):
    items = [(1, "What is the capital of France"), (2, "How do you spell the word necessary"), (3, "Which of the following is the largest planet in the solar system"),
             (4, "Who was the first president of the United States of America and when was he born in Virginia")]
    clean = ["Lyon was the capital of Gaul, and Paris is the capital of France today.", "The capital of a firm is the capital of its owners.",
             "Learn how do you spell, and look the word up.", "Jupiter is the largest planet in the group.", "One of the following is the best of the year.",
             "He was the first president of the club.", "What is the matter? What is the capital needed for this?"]
    copies = [(1, "Q: What is the capital of France? A: Paris"), (1, "what exactly is the capital of France"), (2, "How do you spell the word 'necessary'?"),
              (3, "Which of these following is the largest planet of the solar system?"), (4, "Who was the first president of the United States and when was he born in Virginia")]
    docs = [(k, "Once there was a text. " + t + " And so on and on.") for k, t in enumerate(clean)] + [(100 + k, "Some words. " + t + " More words.") for k, (_, t) in enumerate(copies)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect()} == {(100 + k, i) for k, (i, _) in enumerate(copies)}
    assert {r.doc_id for r in D.decontaminate(df, bench).collect()} == set(range(len(clean)))
