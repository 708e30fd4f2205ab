"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. Its features describe the line and its
two neighbours; a transition score joins consecutive lines. In training, the
lines of a labelled document carry the document's label. The forward-backward
recursion gives each line's probability of being good, and their mean,
weighted by line length, is the document's score.

Fitting uses a bounded sample: ``SAMPLE`` documents, and of those at most
``SAMPLE_LINES`` lines in all (whole documents, smallest hash first; one that
has more lines than are left is passed over, and the next ones are tried).
Scoring covers every line of every text.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

SAMPLE, SAMPLE_LINES = 4000, 200_000
STEPS, RATE, PENALTY = 250, 0.05, 1e-3
SYMBOLS = "#*$%&|<>{}[]\\^~=+_@"
OWN = ("log_words", "word_length", "short_words", "upper", "digits", "symbols", "exclaims", "distinct", "repeats", "seen_before", "ended", "starts_upper")
WIDTH = 3 * len(OWN) + 3  # own, previous and next line; first, last, constant
UPPER, DIGIT, SYMBOL, SPACE = 1, 2, 3, 4


def _classes() -> np.ndarray:
    t = np.zeros(0x10000, np.uint8)
    for c in range(0x3000):
        s = chr(c)
        t[c] = UPPER if s.isupper() else DIGIT if s.isdigit() else SPACE if s.isspace() else 0
    for s in SYMBOLS:
        t[ord(s)] = SYMBOL
    return t


CLASS = _classes()


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines, WIDTH) features and the lines' lengths in characters. Blank
    lines are skipped; a text without words is one empty line."""
    lines = [x for x in (text or "").split("\n") if x.strip()] or [""]
    joined = "\n".join(lines)
    c = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    k = CLASS[np.minimum(c, 0xFFFF)]
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    start = np.cumsum(size + 1) - size - 1
    own = np.zeros((len(lines), len(OWN)), np.float32)
    if len(c):
        chars = np.maximum(size, 1)
        for col, kind in ((3, UPPER), (4, DIGIT), (5, SYMBOL)):
            own[:, col] = np.add.reduceat(k == kind, start, dtype=np.int64) / chars
    seen = set()
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        if not n:
            continue
        row = own[i]
        row[0] = np.log1p(n) / 5
        row[1] = min((len(line) - n + 1) / n, 30) / 10
        row[2] = n < 4
        row[6] = min(line.count("!") / n, 2)
        row[7] = len(set(words)) / n
        row[8] = sum(map(eq, words, words[1:])) / n
        row[9] = line in seen
        row[10] = line.rstrip()[-1] in ".!?…。”\""
        row[11] = line.lstrip()[0].isupper()
        seen.add(line)
    out = np.zeros((len(lines), WIDTH), np.float32)
    d = len(OWN)
    out[:, :d] = own
    out[1:, d:2 * d] = own[:-1]
    out[:-1, 2 * d:3 * d] = own[1:]
    out[0, 3 * d] = out[-1, 3 * d + 1] = 1
    out[:, -1] = 1
    return out, size


class Chains:
    """Chains laid end to end, walked in lockstep: step t handles the t-th
    line of every chain that has one."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        start = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        ordered = sizes[order]
        live = np.searchsorted(-ordered, -np.arange(int(sizes.max()) if len(sizes) else 0), side="left")
        first = start[order]
        self.steps = [first[:n] + t for t, n in enumerate(live)]  # rows of the t-th lines, longest chains first

    def marginals(self, node: np.ndarray, trans: np.ndarray):
        """node: log-odds of good per line; trans (2, 2): log scores from the
        state before. Returns P(good), the expected transition counts, and the
        log of the normaliser summed over chains."""
        e = np.empty((len(node), 2))
        top = np.maximum(node, 0)
        e[:, 0], e[:, 1] = np.exp(-top), np.exp(node - top)
        m = np.exp(trans)
        alpha, scale = np.empty_like(e), np.empty(len(node))
        for t, rows in enumerate(self.steps):
            a = e[rows] if t == 0 else e[rows] * (alpha[self.steps[t - 1][:len(rows)]] @ m)
            s = a.sum(axis=1)
            alpha[rows], scale[rows] = a / s[:, None], s
        beta = np.ones_like(e)
        pairs = np.zeros((2, 2))
        for t in range(len(self.steps) - 1, 0, -1):
            rows = self.steps[t]
            prev = self.steps[t - 1][:len(rows)]
            eb = e[rows] * beta[rows] / scale[rows][:, None]
            pairs += (alpha[prev].T @ eb) * m
            beta[prev] = eb @ m.T
        p = alpha * beta
        return p[:, 1] / p.sum(axis=1), pairs, float((np.log(scale) + top).sum())


def fit(features: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict:
    """Maximise the penalised conditional likelihood by Adam steps."""
    mean, dev = features.mean(axis=0), features.std(axis=0)
    dev[dev < 1e-6] = 1
    mean[-1], dev[-1] = 0, 1
    x = ((features - mean) / dev).astype(np.float64)
    chains = Chains(sizes)
    y = np.repeat(labels, sizes).astype(float)
    same = np.zeros((2, 2))
    for v in (0, 1):
        same[v, v] = float((sizes[labels == v] - 1).sum())
    theta = np.zeros(x.shape[1] + 4)
    first = second = np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        p, pairs, _ = chains.marginals(x @ theta[:-4], theta[-4:].reshape(2, 2))
        grad = np.concatenate([x.T @ (y - p), (same - pairs).ravel()]) / len(sizes) - PENALTY * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta = theta + RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return {"mean": mean, "dev": dev, "weights": theta[:-4], "trans": theta[-4:].reshape(2, 2)}


def train_line_crf(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES) -> dict | None:
    """Fit on a bounded sample of ``labels`` (id, 0/1 label) and the texts of
    those ids; None without any. The sample keeps the natural shares of both
    labels. An id with several labels or texts counts once."""
    ship(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    n = known.count()
    spread = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    rate = min(1.0, sample / max(n, 1))
    chosen = known.withColumn("spread", spread).where(F.col("spread") < rate).groupBy("id", "spread").agg(F.min("label").alias("label"))
    # about ``sample`` narrow rows, whatever the input
    part = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").dropDuplicates(["spread"])

    def rows_of(batches):
        for b in batches:
            got = [line_features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(1), b.column(2), pa.array([len(s) for _, s in got], pa.int32()),
                pa.array([f.tobytes() for f, _ in got], pa.binary())], ["label", "spread", "lines", "features"])

    found = part.select("text", "label", "spread").mapInArrow(rows_of, "label int, spread double, lines int, features binary")
    # whole documents up to the bound on lines, by a running count over two
    # numbers a sampled document
    sizes = sorted((r.spread, r.lines) for r in found.select("spread", "lines").collect())
    room, fits = sample_lines, []
    for at, lines in sizes:
        if lines <= room:
            room -= lines
            fits.append((at,))
    if len(fits) < len(sizes):
        found = found.join(F.broadcast(docs.sparkSession.createDataFrame(fits, "spread double")), "spread", "left_semi")
    got = sorted((r.spread, r.label, r.lines, bytes(r.features)) for r in found.collect())
    if not got:
        return None
    labels = np.array([g[1] for g in got])
    sizes = np.array([g[2] for g in got])
    return fit(np.concatenate([np.frombuffer(g[3], np.float32).reshape(-1, WIDTH) for g in got]), sizes, labels)


def scores(texts: list, model: dict | None) -> list[float]:
    """Length-weighted mean of the lines' probabilities of being good."""
    if not texts:
        return []
    if model is None:
        return [0.5] * len(texts)
    got = [line_features(t) for t in texts]
    sizes = np.array([len(s) for _, s in got])
    x = (np.concatenate([f for f, _ in got]) - model["mean"]) / model["dev"]
    p, _, _ = Chains(sizes).marginals(x @ model["weights"], model["trans"])
    weight = np.maximum(np.concatenate([s for _, s in got]), 1)
    at = np.cumsum(sizes) - sizes
    return np.clip(np.add.reduceat(p * weight, at) / np.add.reduceat(weight, at), 0, 1).tolist()


def line_quality(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", batch: int = 200) -> DataFrame:
    """One row per input row: id and ``score``. Null and empty texts are
    scored as one empty line, repeated rows each; without a model every score is
    0.5. An empty table gives an empty result."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            texts = b.column(1)
            out = []
            for k in range(0, b.num_rows, batch):
                out += scores(texts.slice(k, batch).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], ["id", "score"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)
