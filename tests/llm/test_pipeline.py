import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from denialscope.llm.piece_lattice import decode_documents

#: Names that the stages and their operators use themselves.
CLASHES = ["_quality", "wq__f", "wq__v", "wq__row", "wq__text", "__lang", "__score", "__like", "__row", "key", "id", "row", "fp", "component_id", "block",
           "kind", "data", "word", "words", "item_id", "hits", "n_pieces", "label", "votes", "posterior"]
SYLLABLES = {"en": ["th", "ing", "er", "on", "and"], "de": ["sch", "ung", "keit", "ver", "ein"]}


def prose(rng, lang, n):
    out = []
    while n > 0:
        k = min(n, rng.randint(5, 12))
        out.append(" ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(k)).capitalize() + ".")
        n -= k
    return "\n".join(out)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with their fates, and a folder that holds them."""
    rng = random.Random(8)
    rows, fate = [], {}

    def add(text, lang, what):
        rows.append((len(rows), text, lang, "s", len(text or ""), "clash"))
        fate[len(rows) - 1] = what

    clean = [prose(rng, rng.choice(["en", "de"]), rng.randint(60, 250)) for _ in range(120)]
    item = prose(rng, "en", 40)
    for t in clean:
        add(t, "en" if "ing" in t else "de", "kept")
    for k in range(30):
        add(" ".join(w + rng.choice(["###", "$$$", "&&&"]) for w in prose(rng, "en", 80).split(" ")), "en", "rules")
    for k in range(5):
        add("too short", "en", "rules")
        add(" ".join(str(rng.randrange(10**4, 10**5)) + "." for _ in range(40)), "en", "language")
        add(clean[3], "en", "copy")
        add(clean[7].replace(clean[7].split()[20], "changed", 1), "de", "near")
        add(prose(rng, "en", 30) + "\n" + item + "\n" + prose(rng, "en", 60), "en", "leak")
    add(None, None, "rules")
    add("", None, "rules")
    top = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string") \
        .withColumns({c: F.lit("clash") for c in CLASHES}).coalesce(2).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return str(top), rows, fate


def test_stages_keep_columns_and_take_effect(spark, corpus):
    top, rows, fate = corpus
    docs = spark.read.parquet(f"{top}/documents.parquet")
    gone_after = {"quality_rules": "rules", "language_id": "language", "benchmark_decontamination": "leak"}
    for name, stage in C.STAGES[:-1]:
        after = C.written(stage(spark, docs, top), name)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        lost = {r.doc_id for r in docs.join(after, "doc_id", "left_anti").collect()}
        if name == "simhash_dedup":
            # the first text of a class stays
            assert {i for i, f in fate.items() if f == "copy"} <= lost <= {i for i, f in fate.items() if f in ("copy", "near")}
        else:
            want = {i for i, f in fate.items() if f == gone_after[name]}
            assert want <= lost and len(lost - want) <= 2, name
        docs = after
    assert {i for i, f in fate.items() if f == "kept"} - {r.doc_id for r in docs.collect()} == set() or docs.count() >= 117


def test_run_decodes_to_kept_texts(spark, corpus):
    top, rows, fate = corpus
    got = C.run(spark, top)
    back = {r.doc_id: r.text for r in decode_documents(got).collect()}
    assert len(back) == got.count() and got.where(~F.col("round_trip")).isEmpty()
    texts = {r[0]: r[1] for r in rows}
    assert all(back[i] == texts[i] for i in back)
    assert sum(f == "kept" and i in back for i, f in fate.items()) >= 117


def test_empty_and_repeated(spark, corpus, tmp_path):
    top, rows, _ = corpus
    docs = spark.read.parquet(f"{top}/documents.parquet")
    for name, stage in C.STAGES:
        assert stage(spark, docs.limit(0), top).count() == 0
    again = docs.where("doc_id < 5").union(docs.where("doc_id < 5")).withColumn("doc_id", F.when(F.col("doc_id") > 2, F.col("doc_id")))
    assert C.simhash_dedup(spark, again, top).count() == 5


FOREIGN = {
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
    "zh": "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
    "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
}
MORE = {**SYLLABLES, "fr": ["eau", "tion", "que", "elle", "oi"], "es": ["ci", "ar", "mente", "os", "la"]}


@pytest.mark.parametrize("learned", [["en", "de"], ["en", "de", "fr"], ["en", "de", "fr", "es"]])
def test_unlearned_languages_and_gibberish_are_dropped(spark, monkeypatch, learned):
    for k, v in MORE.items():
        monkeypatch.setitem(SYLLABLES, k, v)
    rng = random.Random(11)
    rows = [(i, prose(rng, learned[i % len(learned)], rng.randint(20, 250)), learned[i % len(learned)]) for i in range(60 * len(learned))]
    kept = len(rows)
    for text in FOREIGN.values():
        rows.append((len(rows), text, None))
    for _ in range(5):
        rows.append((len(rows), " ".join("%08x" % rng.getrandbits(32) for _ in range(60)), None))
        rows.append((len(rows), " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randint(2, 9))) for _ in range(60)), None))
        for other in MORE.keys() - set(learned):
            rows.append((len(rows), prose(rng, other, 120), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id for r in C.language_id(spark, docs, "").collect()}
    assert {i for i in got if i >= kept} == set()
    assert len(got) >= 0.99 * kept


def test_run_leaves_only_the_stages_tables(spark, corpus):
    """A stage's own tables go with it; a failed step's go too."""
    import os

    from denialscope.llm.common import scratch, written
    from denialscope.session import shared_dir
    top, _, _ = corpus
    folder = shared_dir(spark)
    before = set(os.listdir(folder))
    assert C.run(spark, top).count() > 0
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before if "-" in x and os.listdir(f"{folder}/{x}")}
    assert {x for x in left if x.startswith("pipeline-")} == {f"pipeline-{name}" for name, _ in C.STAGES}
    assert not left & {"weak-quality", "dedup-rows", "blocks", "lm-words"}
    before = set(os.listdir(folder))
    with pytest.raises(ZeroDivisionError), scratch(spark):
        kept = written(spark.range(3), "kept", keep=True)
        assert written(spark.range(4), "gone").count() == 4
        raise ZeroDivisionError
    assert [x.split("-")[0] for x in set(os.listdir(folder)) - before] == ["kept"] and kept.count() == 3
