"""Document probability from a subword lattice.

The vocabulary is given; its scores weight all segmentations of a word. From
those weights expectation-maximisation over the distinct training words
re-estimates the pieces' probabilities (forward-backward in log space, in the
tasks; to the driver comes one number a piece). A training word is also an arc
of its own over the whole lattice, with its count less a discount; what the
discounts free goes to the spelt arcs. The log-space forward recursion gives
the marginal probability of each word, and a document's is the product over
its words and one end (``score``). ``lattice_score`` is the same without whole-
word arcs: each word's marginal over the segmentations alone, times the share
of words among the training tokens.

Also counted: tokens, known tokens, and the add-one unigram baseline over all
training tokens. Null texts are empty: their only token is the end. Repeated
rows are scored (and, in training, counted) each.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import blocked, document_chunks, gathered, meet, word_chunks
from .common import released, ship, written
from .subword import Lattice, vocabulary

TOKENIZER = "piece_bpe_32k.model"
ROUNDS = 2
PRIOR_USES = 1000.0   # weight of the vocabulary's own scores against the words'
FLUSH_WORDS = 1 << 20


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def block_words(rows: DataFrame) -> DataFrame:
    """(word, block, n) of ``rows(block, train, text)``: a block's distinct
    words and how often its training documents have each. A block that is read
    in several pieces (its file is split at a row group, or it has very many
    words) has a row for each."""
    def run(batches):
        held, block = Counter(), None

        def out():
            words = [w.decode("utf-8", "replace") for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([block] * len(words), pa.int64()), pa.array(list(held.values()), pa.int64())], ["word", "block", "n"])

        for b in batches:
            for at, train, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if block != at or len(held) > FLUSH_WORDS:
                    if held:
                        yield out()
                    held, block = Counter(), at
                w = tokens(text)
                if train:
                    held.update(w)
                else:
                    for x in w:
                        if x not in held:
                            held[x] = 0
        if held:
            yield out()
    return rows.select("block", "train", "text").mapInArrow(released(run), "word string, block long, n long")


def estimate(words: DataFrame, tokenizer: str, rounds: int) -> np.ndarray:
    """Probabilities of the pieces after ``rounds`` rounds over the distinct
    training words, each once: spelt arcs stand for what is rare."""
    vocab = vocabulary(tokenizer)
    p = vocab.prior
    for _ in range(rounds):
        log_p = np.log(np.where(p > 0, p, 1e-300))

        def expect(batches, log_p=log_p):
            lattice = Lattice(vocabulary(tokenizer), log_p)
            use = np.zeros(len(log_p))
            for b in gathered(batches):
                use += lattice.expected(b.column(0).to_pylist(), np.ones(b.num_rows))
            at = np.flatnonzero(use)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(use[at])], ["piece", "uses"])

        use = np.zeros(len(p))
        for r in words.mapInArrow(released(expect), "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            use[r.piece] = r.uses  # at most one row a piece of the vocabulary
        p = (use + PRIOR_USES * vocab.prior) / (use.sum() + PRIOR_USES)
    return p


def lattice_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer: str = TOKENIZER, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` and ``lattice_score`` (log10). ``train`` marks the documents to
    learn from; with none, words are only spelt, by the vocabulary's own
    scores."""
    spark = docs.sparkSession
    ship(spark)
    rows = blocked(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train")))
    words = written(block_words(rows).groupBy("word").agg(F.sum("n").alias("n"), F.collect_set("block").alias("blocks")), "lm-words")
    ends = rows.where("train").count()
    seen = F.col("n") > 0
    total, kinds, once, twice = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(seen, 1)), F.count(F.when(F.col("n") == 1, 1)), F.count(F.when(F.col("n") == 2, 1))).first()
    n, v = total + ends, kinds + (ends > 0)
    discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
    p = estimate(words.where(seen).select("word"), tokenizer, rounds if kinds else 0)
    log_p = np.log(np.where(p > 0, p, 1e-300))
    spelt = math.log(discount * kinds / n) if kinds else 0.0
    end_score = math.log10(max(ends - discount, 0.5) / max(n, 1))
    # an event never seen in training has half a token
    lattice_word, lattice_end = (math.log10(max(x, 0.5) / max(n, 1)) for x in (total, ends))
    floor = math.log10(n + (v + 1))
    end_base = math.log10(ends + 1) - floor

    def values(b):
        lattice = Lattice(vocabulary(tokenizer), log_p)
        c = b.column("n").to_numpy().astype(float)
        marginal = lattice.log_probability(b.column("word").to_pylist())
        score = spelt + marginal
        own = c > discount
        whole = np.log(np.where(own, c - discount, 1.0)) - math.log(max(n, 1))
        score = np.where(own, np.logaddexp(score, whole), score)
        return [pa.array(b.column("n")), pa.array(score / math.log(10)), pa.array(marginal / math.log(10))]

    def load(parts):
        index, count, score, marginal = {}, [], [], []
        for part in parts:
            for w in part.column(0).to_pylist():
                index.setdefault(w.encode(), len(index))
            count.append(part.column(1).to_numpy())
            score.append(part.column(2).to_numpy())
            marginal.append(part.column(3).to_numpy())
        count = np.concatenate(count) if count else np.empty(0, np.int64)
        return index, np.log10(count + 1.0), count > 0, *(np.concatenate(x) if x else np.empty(0) for x in (score, marginal))

    def apply(state, chunk):
        index, log_count, known, score, marginal = state
        out = []
        for t in chunk.column(1).to_pylist():
            w = tokens(t)
            at = np.fromiter(map(index.__getitem__, w), np.int64, len(w))
            out.append((len(w) + 1, int(known[at].sum()) + (ends > 0), float(log_count[at].sum()) - len(w) * floor + end_base, float(score[at].sum()) + end_score,
                        float(marginal[at].sum()) + len(w) * lattice_word + lattice_end))
        cols = [pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))]
        return pa.RecordBatch.from_arrays([chunk.column(0), *cols], ["id", "n_tokens", "n_known", "base_score", "score", "lattice_score"])

    kind = rows.schema["id"].dataType.simpleString()
    got = meet(document_chunks(rows), word_chunks(words, values, ["n", "score", "marginal"]), load, apply,
               f"id {kind}, n_tokens long, n_known long, base_score double, score double, lattice_score double")
    return got.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", "lattice_score")
