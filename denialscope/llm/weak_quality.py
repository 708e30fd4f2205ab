"""Quality rules by weak supervision, in DataFrame functions only.

Nine rules vote on a document: 1 (good), -1 (bad) or 0 (abstain).
Expectation-maximisation over the counts of the vote patterns of all
documents that pass the base check (at most 3**9 rows, whatever the input) estimates how often each
rule is right on good and on bad documents, without labels; the
posterior probability of "good" then takes the place of the test that all
rules pass. ``base_failed`` documents are rejected in any case.

Texts are read once; the features are written to the shared folder and the
counting and the result read that copy. Null texts count as empty, have no
words, and fail the base check. Repeated rows are judged row by row; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
THRESHOLD = 0.5
#: The least share of distinct words, and the length from which the bound on
#: them grows like the root of the words only, as vocabularies do (Heaps).
LEAST_DISTINCT, HEAPS_FROM = 0.25, 20_000
RULES = ("symbols", "symbol_words", "shouting", "repeats", "variety", "lines", "endings", "word_length", "exclaims")
#: Where estimation starts: the share of good documents; how often a vote on a
#: good document is "good"; how often a vote on a bad one is "bad" (a bad
#: document breaks some rules, seldom most).
PRIOR_GOOD, START_RIGHT_GOOD, START_RIGHT_BAD = 0.8, 0.95, 0.4
ROUNDS, TOLERANCE = 200, 1e-9


def word_features(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with a struct ``wq__f`` of counts over the whole text."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    df = df.select(*keep, F.filter(F.split(text, SPACE), lambda w: w != "").alias("wq__w"))
    df = df.select(*keep, F.size(F.filter("wq__w", lambda w: w.rlike("[#*$%&|<>]"))).alias("wq__s"), F.transform("wq__w", lambda w: F.xxhash64(w)).alias("wq__w"))
    keep.append(F.col("wq__s"))
    n = F.size("wq__w")
    window = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("wq__w"), i + k) for k in range(WINDOW)]))
    df = df.select(*keep, n.alias("wq__n"), F.size(F.array_distinct("wq__w")).alias("wq__d"), F.when(n >= WINDOW, window).alias("wq__g"))
    # only texts with some window twice are sorted
    twice = F.size(F.array_distinct("wq__g")) < F.size("wq__g")
    df = df.select(*keep, "wq__n", "wq__d", F.when(twice, F.sort_array(F.transform("wq__g", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))).alias("wq__g"))
    here, at = F.col("wq__g"), lambda i: F.get(F.col("wq__g"), i)["h"]
    same = F.filter(here, lambda x, i: ((i > 0) & (at(i - 1) == x["h"])) | F.coalesce(at(i + 1) == x["h"], F.lit(False)))
    df = df.select(*keep, "wq__n", "wq__d", F.sort_array(F.transform(same, lambda x: x["p"])).alias("wq__g"))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate("wq__g", start, lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    long = lambda c: c.cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.select(*keep, "wq__n", "wq__d", F.coalesce(covered, F.lit(0)).alias("wq__r"), lines.alias("wq__l"))
    gone = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    return df.select(*keep[:-1], F.struct(
        long(F.col("wq__n")).alias("n_words"),
        long(F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))).alias("word_chars"),
        long(gone(SYMBOLS)).alias("n_symbols"),
        long(F.size("wq__l") - F.size(F.array_distinct("wq__l"))).alias("n_dup_lines"),
        long(F.col("wq__r")).alias("n_repeat_words"),
        long(F.col("wq__d")).alias("n_distinct"),
        long(F.col("wq__s")).alias("n_symbol_words"),
        long(F.size("wq__l")).alias("n_lines"),
        long(F.size(F.filter("wq__l", lambda x: x.rlike("[.!?…:;\"”»)\\]。！？]\\s*$")))).alias("n_ended"),
        long(F.length(text) - F.length(F.regexp_replace(text, "\\p{Lu}+", ""))).alias("n_upper"),
        long(gone("!")).alias("n_exclaims")).alias("wq__f"))


def rule_votes(f: Column) -> list[Column]:
    """One vote a rule, in the order of ``RULES``."""
    n, lines = f["n_words"], f["n_lines"]
    some = n >= 20
    few = LEAST_DISTINCT * F.least(n.cast("double"), F.sqrt(n * float(HEAPS_FROM)))
    vote = lambda bad, good: F.when(bad, -1).when(good, 1).otherwise(0)
    return [
        vote((n > 0) & (f["n_symbols"] > 0.1 * n), (n > 0) & (f["n_symbols"] <= 0.01 * n)),
        vote((n > 0) & (f["n_symbol_words"] > 0.1 * n), (n > 0) & (f["n_symbol_words"] <= 0.01 * n)),
        vote(some & (f["n_upper"] > 0.2 * f["word_chars"]), some & (f["n_upper"] < 0.1 * f["word_chars"])),
        vote(some & (f["n_repeat_words"] > 0.1 * n), some & (f["n_repeat_words"] <= 0.02 * n)),
        vote((n >= 50) & (f["n_distinct"] < few), (n >= 50) & (f["n_distinct"] > 0.45 * n)),
        vote((lines >= 4) & (f["n_dup_lines"] > 0.3 * lines), (lines >= 4) & (f["n_dup_lines"] <= 0.1 * lines)),
        vote((lines >= 2) & (f["n_ended"] < 0.4 * lines), (lines >= 2) & (f["n_ended"] > 0.8 * lines)),
        vote(some & ((f["word_chars"] > 7.0 * n) | (f["word_chars"] < 2.5 * n)), some & f["word_chars"].between(3.5 * n, 6.5 * n)),
        vote(some & (f["n_exclaims"] > 0.2 * n), some & (f["n_exclaims"] < 0.05 * n)),
    ]


def estimate(patterns: dict[tuple, int]) -> tuple[float, list[dict]]:
    """Class prior and, for each rule, log P(vote | good) - log P(vote | bad)
    among the documents it votes on, by expectation-maximisation over counted
    vote patterns. Abstaining says nothing about the class."""
    k, total = len(RULES), sum(patterns.values())
    prior = PRIOR_GOOD
    right = [[START_RIGHT_BAD, START_RIGHT_GOOD] for _ in range(k)]  # P(right vote | bad), P(right vote | good)

    def odds():
        return [{1: math.log(g / (1 - b)), -1: math.log((1 - g) / b), 0: 0.0} for b, g in right]

    order = sorted(patterns.items())
    for _ in range(ROUNDS):
        now, old = odds(), prior
        good, cast, correct = 0.0, [[0.0, 0.0] for _ in range(k)], [[0.0, 0.0] for _ in range(k)]
        for votes, count in order:
            score = math.log(prior / (1 - prior)) + sum(now[j][v] for j, v in enumerate(votes))
            p = 1 / (1 + math.exp(-score)) if score > -700 else 0.0
            good += count * p
            for j, v in enumerate(votes):
                if v:
                    cast[j][0] += count * (1 - p)
                    cast[j][1] += count * p
                    correct[j][v > 0] += count * (p if v > 0 else 1 - p)
        # pseudo-counts of one document that the start describes
        prior = (good + PRIOR_GOOD) / (total + 1)
        right = [[(correct[j][y] + r) / (cast[j][y] + 1) for y, r in enumerate((START_RIGHT_BAD, START_RIGHT_GOOD))] for j in range(k)]
        if abs(prior - old) < TOLERANCE:
            break
    return prior, odds()


def weak_quality(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, columns: list[str] | None = None,
                 out: str = "_quality") -> DataFrame:
    """The rows of ``docs`` with ``columns`` (all, unless given) plus a struct ``out``: the counts,
    ``votes``, ``posterior`` (probability that the document is good),
    ``base_failed`` and ``kept``. A column of the name ``out`` is replaced; the
    others may have any name."""
    f = F.col("wq__f")
    names_out = [c for c in (docs.columns if columns is None else columns) if c.lower() != out.lower()]
    # the caller's columns travel in one struct: none of their names can meet one of ours
    row = F.struct(*[F.col(f"`{c}`") for c in names_out]).alias("wq__row") if names_out else F.lit(0).alias("wq__row")
    featured = word_features(docs.select(row, F.col(f"`{text_col}`").alias("wq__text")), "wq__text")
    keep = [F.col("wq__row")]
    table = written(featured.select(*keep, "wq__f", F.array(*[v.cast("tinyint") for v in rule_votes(f)]).alias("wq__v")), "weak-quality")
    n = f["n_words"]
    failed = (n < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
    # what the base check rejects is settled; the rules are estimated on the rest
    counted = table.where(~failed).groupBy("wq__v").count().collect()  # at most 3 ** len(RULES) rows
    prior, odds = estimate({tuple(r["wq__v"]): r["count"] for r in counted})
    score = F.lit(math.log(prior / (1 - prior)))
    for j, o in enumerate(odds):
        v = F.get(F.col("wq__v"), F.lit(j))
        score = score + F.when(v == -1, o[-1]).when(v == 1, o[1]).otherwise(o[0])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = table.select(*keep, "wq__f", "wq__v", (1 / (1 + F.exp(-score))).alias("wq__p"), failed.alias("wq__b"))
    back = [F.col(f"wq__row.`{c}`").alias(c) for c in names_out]
    return judged.select(*back, F.struct(*[f[x].alias(x) for x in names], F.col("wq__v").alias("votes"), F.col("wq__p").alias("posterior"),
                                         F.col("wq__b").alias("base_failed"), (~F.col("wq__b") & (F.col("wq__p") >= threshold)).alias("kept")).alias(out))
