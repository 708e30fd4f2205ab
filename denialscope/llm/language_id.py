"""Language identification with blended-spectrum string kernels.

A text is the set of its character n-grams of 1 to ``ORDER`` letters, hashed
into ``SLOTS`` slots (presence, not counts); the kernel of two texts is the
size of their sets' intersection over the geometric mean of their sizes.
Nystroem features against landmark texts feed a one-versus-rest ridge
regression. Both are fitted on the driver from a bounded sample (``SAMPLE``
rows, 8 KB of bits each); a batch of texts is then scored by two matrix
products in the tasks.

The margins only compare the learned languages with each other. Whether a text
is in one of them at all is its likeness: the mean kernel to a language's
landmarks over what the sample's texts of that language and size have (medians
of bins by size, a landmark not compared with itself), the largest over the
languages. More languages do not lower it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import released, ship
from .sampling import bounded_sample

ORDER, SLOTS = 4, 1 << 16
SAMPLE, LANDMARKS = 1600, 192
RIDGE = 1e-3
BATCH = 256
#: Rows in a bin of the likeness curve, and the most bins of one.
BIN_ROWS, BINS = 8, 12
UNKNOWN = "und"
CHUNK = 1 << 18


def presence(text: str, mark: np.ndarray) -> None:
    """Set the slots of the text's n-grams in ``mark`` (whole text, in chunks
    that overlap by an n-gram)."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    for k in range(0, len(c), CHUNK):
        part = c[k:k + CHUNK + ORDER - 1]
        h = part * np.uint32(0x9E3779B1)
        mark[h >> np.uint32(16)] = True
        for n in range(1, min(ORDER, len(part))):
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + part[n:] * np.uint32(0x9E3779B1)
            mark[h >> np.uint32(16)] = True


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Model:
    """Landmarks, their sizes, and the weights from kernels to languages."""

    def __init__(self, languages: list[str], slots: np.ndarray, landmarks: np.ndarray, sizes: np.ndarray, weights: np.ndarray):
        self.languages, self.slots, self.landmarks, self.sizes, self.weights = languages, slots, landmarks, sizes, weights
        self.bias = np.zeros(weights.shape[1], np.float32)

    def kernels(self, marks: np.ndarray) -> np.ndarray:
        """(texts, landmarks) kernels of a batch of presence rows."""
        size = np.maximum(marks.sum(axis=1), 1).astype(np.float32)
        if self.landmarks.dtype != np.float32:  # they travel as bytes
            self.landmarks = self.landmarks.astype(np.float32)
        k = marks[:, self.slots].astype(np.float32) @ self.landmarks
        return k / np.sqrt(size)[:, None] / np.sqrt(self.sizes)

    def scores(self, marks: np.ndarray) -> np.ndarray:
        """(texts, languages) margins of a batch of presence rows."""
        return self.kernels(marks) @ self.weights

    def learn_likeness(self, of: np.ndarray, at: np.ndarray, y: np.ndarray, kernels: np.ndarray, sizes: np.ndarray) -> None:
        """``of``: languages of the landmarks, ``at``: their rows in the
        sample, whose languages, kernels and sizes are the rest."""
        self.of, self.curves = of, []
        for k in range(len(self.languages)):
            rows, own = np.flatnonzero(y == k), np.flatnonzero(of == k)
            itself = np.isin(rows, at)
            others = len(own) - itself
            mass = kernels[np.ix_(rows, own)].sum(axis=1) - np.where(itself, 1, 0)
            some = (others > 0) & (mass > 0)
            x, m = np.log(np.maximum(sizes[rows][some], 1)), np.log(mass[some] / others[some])
            order = np.argsort(x, kind="stable")
            bins = np.array_split(order, min(BINS, max(1, len(order) // BIN_ROWS))) if len(order) else []
            self.curves.append((np.array([np.median(x[b]) for b in bins]), np.array([np.median(m[b]) for b in bins])))

    def likeness(self, kernels: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The largest over the languages of the kernel to a language's
        landmarks over what its texts of that size have; 1 if every language
        has too few texts to tell. Outside the sizes of the sample the kernel
        can at most fall like the root of the size."""
        out = np.zeros(len(sizes)) if any(len(x) for x, _ in self.curves) else np.ones(len(sizes))
        size = np.log(np.maximum(sizes, 1))
        for k, (x, m) in enumerate(self.curves):
            if len(x):
                want = np.interp(size, x, m) - np.maximum(x[0] - size, 0) / 2 - np.maximum(size - x[-1], 0) / 2
                np.maximum(out, kernels[:, self.of == k].mean(axis=1) / np.exp(want), out=out)
        return out


def fit(marks: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Kernel ridge regression on Nystroem features of the sample."""
    if not langs:
        return None
    languages = sorted(set(langs))
    y = np.array([languages.index(x) for x in langs])
    each = max(1, landmarks // len(languages))
    at = np.concatenate([np.flatnonzero(y == k)[:each] for k in range(len(languages))])
    chosen = marks[at]
    slots = np.flatnonzero(chosen.any(axis=0))
    lm = np.ascontiguousarray(chosen[:, slots].T)
    sizes = np.maximum(chosen.sum(axis=1), 1).astype(np.float32)
    model = Model(languages, slots, lm, sizes, np.eye(len(at), dtype=np.float32))
    k_ll = model.scores(chosen).astype(np.float64)
    value, vector = np.linalg.eigh((k_ll + k_ll.T) / 2)
    good = value > 1e-8 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    kernels = np.concatenate([model.kernels(marks[k:k + BATCH]) for k in range(0, len(marks), BATCH)])
    phi = kernels.astype(np.float64) @ root
    phi = np.hstack([phi, np.ones((len(phi), 1))])
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # every language weighs the same
    w = (1.0 / np.bincount(y))[y][:, None] * len(y) / len(languages)
    beta = np.linalg.solve(phi.T @ (w * phi) + ridge * len(y) * np.eye(phi.shape[1]), phi.T @ (w * target))
    model.landmarks = lm
    model.weights = (root @ beta[:-1]).astype(np.float32)
    model.bias = beta[-1].astype(np.float32)
    model.learn_likeness(y[at], at, y, kernels, marks.sum(axis=1))
    return model


def train_language_id(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model | None:
    """Fit on at most about ``sample`` rows with a language and letters; None
    if there is none."""
    ship(rows.sparkSession)
    picked = bounded_sample(rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
                            .where("lang is not null and text is not null"), "id", "lang", sample)

    def bits(batches):
        for b in batches:
            out, lang = [], []
            for t, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if has_letter(t):
                    mark = np.zeros(SLOTS, bool)
                    presence(t, mark)
                    out.append(np.packbits(mark).tobytes())
                    lang.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(out, pa.binary())], ["lang", "bits"])

    got = sorted((r.lang, bytes(r.bits)) for r in picked.select("text", "lang").mapInArrow(bits, "lang string, bits binary").collect())
    marks = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for _, b in got], bool).reshape(len(got), SLOTS)
    return fit(marks, [x for x, _ in got], landmarks)


def predict_language(docs: DataFrame, model: Model | None, text_col: str = "text",
                     lang_out: str = "lang_pred", score_out: str = "score", like_out: str | None = None) -> DataFrame:
    """The rows and columns of ``docs`` plus the language and its score, 0 to
    1, and if named its likeness; columns that have those names are replaced.
    Null texts and texts without a letter are ``und`` with score and likeness
    0. Repeated rows are judged one by one; an empty table gives none."""
    ship(docs.sparkSession)
    new = {c.lower() for c in (lang_out, score_out, like_out) if c}
    if any(c.lower() in new for c in docs.columns):
        docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = b.column(at)
            lang, score, like = [], [], []
            for k in range(0, b.num_rows, BATCH):
                part = texts.slice(k, BATCH).to_pylist()
                known = [has_letter(t) and model is not None for t in part]
                marks = np.zeros((sum(known), SLOTS), bool)
                for row, t in zip(marks, (t for t, ok in zip(part, known) if ok)):
                    presence(t, row)
                if len(marks):
                    kernels = model.kernels(marks)
                    f = kernels @ model.weights + model.bias
                    best = f.argmax(axis=1)
                    p = np.clip((f[np.arange(len(f)), best] + 1) / 2, 0, 1)
                    near = model.likeness(kernels, marks.sum(axis=1)) if like_out else np.zeros(len(f))
                    found = iter(zip((model.languages[x] for x in best), p.astype(float), near.astype(float)))
                for ok in known:
                    x, s, near = next(found) if ok else (UNKNOWN, 0.0, 0.0)
                    lang.append(x)
                    score.append(s)
                    like.append(near)
            extra = [pa.array(like, pa.float64())] if like_out else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), *extra],
                                             names=[*b.schema.names, lang_out, score_out, *([like_out] if like_out else [])])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{lang_out}` string, `{score_out}` double"
    schema += f", `{like_out}` double" if like_out else ""
    return docs.mapInArrow(released(run), schema)


def accepted(lang: Column, score: Column, least: float) -> Column:
    """Whether a document has a recognised language."""
    return (lang != UNKNOWN) & (score >= least)
