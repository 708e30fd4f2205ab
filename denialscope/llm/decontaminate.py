"""Benchmark decontamination: word pairs as seeds, then Smith-Waterman.

A seed is a pair of words that stand next to each other or one place apart.
In an alignment over the threshold, matched words that follow each other with
at most one word inserted, left out or replaced between them are pairs in the
item and in the document; every other step costs at least a matched word's
score, so an item of m words has at least H pairs in the document, H from its
least score. Of these the corpus counts may leave out the H // 2 commonest, and
pairs that never occur; a stretch of the document that has fewer than the rest
on neighbouring diagonals cannot reach the score. The others are aligned with
the item (word by word, local, linear gaps) in a window as wide as the score
allows gaps; the score over the score of a perfect copy decides. No copy over
the threshold is lost to the seeds. A phrase that a short item shares with a
document is not a copy: the alignment must also match ``LEAST_WORDS`` words
(all words of a shorter item), with at most one edit for every two of them.

Test items come in blocks of at most ``BLOCK_BYTES`` of text, each small enough
to go with the tasks; every block meets all documents. Documents are never
shuffled: only the pair counts of a block are.

Words are lower-cased ASCII letters, digits and non-ASCII characters but
punctuation and spaces; everything else separates. In scripts that put no
spaces between words (Chinese, Japanese, Thai, Lao, Khmer, Burmese and the
like) every character is a word. Items with fewer than ``MIN_WORDS`` words
must be in a document word for word, without gaps; items without a word, and
null texts, match nothing.
"""

from __future__ import annotations

import math
import unicodedata
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, ship

REACH, MIN_WORDS = 2, 5
MATCH, MISMATCH, GAP = 2, -1, 1
THRESHOLD = 0.4
#: Matched words that an alignment needs besides its share, and the least score
#: for each of them. At sf0.1 they change nothing: the same 246 documents.
LEAST_WORDS, LEAST_PER_WORD = 8, 1.5
#: Scores carry the number of matched words in their lower bits.
UNIT = 1 << 32
BLOCK_BYTES = 4 << 20
#: Words of a document whose seed hits are held at a time (more for long items).
PART_WORDS = 4096
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


#: Characters of scripts without spaces between words.
_ALONE = ((0xe00, 0xeff), (0x1000, 0x109f), (0x1780, 0x17ff), (0x1950, 0x19df), (0x1a20, 0x1aaf), (0x1b00, 0x1b7f), (0x2e80, 0x2fdf),
          (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x3035), (0x3040, 0x312f), (0x31a0, 0x31ff), (0x3400, 0x4dbf), (0x4e00, 0x9fff),
          (0xa000, 0xa4cf), (0xa980, 0xa9ff), (0xaa60, 0xaadf), (0xf900, 0xfaff), (0xff66, 0xff9f), (0x1aff0, 0x1b16f), (0x20000, 0x3ffff))
_KIND = np.zeros(0x110000, np.uint8)
for _a, _b in _ALONE:
    _KIND[_a:_b + 1] = 2
# non-ASCII punctuation, spaces, control characters and the zero-width space
_KIND[[c for c in range(0x80, 0x20000) if unicodedata.category(chr(c))[0] in "PZ" or unicodedata.category(chr(c)) == "Cc" or c == 0x200B]] = 1
#: Bytes that begin no character of either kind.
_PLAIN = bytes(set(range(256)) - {chr(c).encode()[0] for c in np.flatnonzero(_KIND).tolist()})


def words_of(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "replace")
    if raw.translate(None, _PLAIN):
        c = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        kind = _KIND[c]
        alone = kind == 2
        c = np.where(kind == 1, np.uint32(32), c)
        room = 1 + 2 * alone  # a space on either side
        out = np.full(int(room.sum()), 32, np.uint32)
        out[np.cumsum(room) - room + alone] = c
        raw = out.tobytes().decode("utf-32-le").encode()
    return raw.translate(_FOLD).split()


def least_score(m: int) -> float:
    """Least score of an alignment that counts, for an item of ``m`` words."""
    return MATCH * m if m < MIN_WORDS else max(THRESHOLD * MATCH * m, LEAST_PER_WORD * min(m, LEAST_WORDS))


class Items:
    """A block of test items: words as numbers, word pairs as keys."""

    def __init__(self, rows: list[tuple]):
        self.vocab: dict[bytes, int] = {}
        self.ids, self.words = [], []
        for item_id, text in rows:
            w = words_of(text)
            if w:
                self.ids.append(item_id)
                self.words.append(np.array([self.vocab.setdefault(x, len(self.vocab)) for x in w], np.int64))
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.least = np.array([least_score(m) for m in self.size])
        # gaps and mismatches that the least score leaves room for
        self.slack = np.floor(MATCH * self.size - self.least).astype(np.int64)
        self.singles = np.unique([w[0] for w in self.words if len(w) == 1]).astype(np.int64)
        pairs = [self.pairs(w)[0] for w in self.words]
        self.grams = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)

    def pairs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the pairs of known words at most ``REACH`` places apart
        and of words that are an item, and the place of the first word."""
        keys, at = [], []
        for d in range(1, REACH + 1):
            a, b = numbers[:-d], numbers[d:]
            p = np.flatnonzero((a >= 0) & (b >= 0))
            keys.append(a[p] * len(self.vocab) + b[p])
            at.append(p)
        if len(self.singles):
            p = np.flatnonzero(np.isin(numbers, self.singles))
            keys.append(len(self.vocab) ** 2 + numbers[p])
            at.append(p)
        return np.concatenate(keys), np.concatenate(at)

    def numbers(self, text: str | None) -> np.ndarray:
        w = words_of(text)
        return np.fromiter(map(self.vocab.get, w, repeat(-1)), np.int64, len(w))

    def choose_seeds(self, counts: np.ndarray) -> None:
        """counts: occurrences of ``self.grams`` in the corpus."""
        key, item, place = [], [], []
        self.need = np.ones(len(self.words), np.int64)
        for i, w in enumerate(self.words):
            k, p = self.pairs(w)
            seen = counts[np.searchsorted(self.grams, k)]
            hits = max(1, math.ceil((self.least[i] - MATCH) / MATCH))
            left_out = hits // 2
            self.need[i] = hits - left_out
            order = np.argsort(seen, kind="stable")[:len(k) - left_out]
            order = order[seen[order] > 0]
            key.append(k[order])
            place.append(p[order])
            item.append(np.full(len(order), i, np.int64))
        key, item, place = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (key, item, place))
        order = np.argsort(key, kind="stable")
        self.seeds, self.start, self.many = np.unique(key[order], return_index=True, return_counts=True)
        self.item, self.place = item[order], place[order]

    def stretches(self, doc: np.ndarray) -> dict[int, list]:
        """item -> windows of the document that may hold it."""
        if not len(self.seeds):
            return {}
        # no alignment covers more words than an item and its gaps, so each
        # lies within one of the overlapping parts
        cover = int((self.size + self.slack).max()) + REACH
        part = max(PART_WORDS, 4 * cover)
        found: dict[int, list] = {}
        for start in range(0, max(1, len(doc) - cover), part - cover):
            self.part_windows(doc, start, min(len(doc), start + part), found)
        if len(doc) > part:
            for i, spans in found.items():
                found[i] = merged(sorted(spans))
        return found

    def part_windows(self, doc: np.ndarray, start: int, stop: int, windows: dict[int, list]) -> None:
        """Add the windows that the seeds of ``doc[start:stop]`` give."""
        key, at = self.pairs(doc[start:stop])
        at = at + start
        if not len(key):
            return
        slot = np.minimum(np.searchsorted(self.seeds, key), len(self.seeds) - 1)
        hit = self.seeds[slot] == key
        at, slot = at[hit], slot[hit]
        many = self.many[slot]
        ends = np.cumsum(many)
        own = np.repeat(self.start[slot] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)
        item = self.item[own]
        longest = int(self.size.max())
        width = len(doc) + 4 * longest + 4
        spot = np.sort(item * width + np.repeat(at, many) - self.place[own] + longest)
        item = spot // width
        last = np.arange(len(spot)) + self.need[item] - 1
        full = last < len(spot)
        full[full] = spot[last[full]] - spot[full] <= self.slack[item[full]]
        for i, diagonal in zip(item[full].tolist(), (spot[full] % width - longest).tolist()):
            room = int(self.slack[i])
            lo, hi = max(0, diagonal - room), min(len(doc), diagonal + int(self.size[i]) + room)
            got = windows.setdefault(i, [])
            if got and got[-1][0] <= lo <= got[-1][1]:
                got[-1] = (got[-1][0], max(hi, got[-1][1]))
            else:
                got.append((lo, hi))

    def found(self, text: str | None) -> dict:
        """item -> (score, first word, last word) of its best alignment in
        the whole text, where that reaches the threshold."""
        doc = self.numbers(text)
        out = {}
        for item, spans in self.stretches(doc).items():
            w = self.words[item]
            best = None
            for lo, hi in spans:
                score, end, matched = align(w, doc[lo:hi])
                share = score / (MATCH * len(w))
                if score >= self.least[item] and matched >= min(len(w), LEAST_WORDS) and (best is None or share > best[0]):
                    _, start, _ = align(w[::-1], doc[lo:lo + end + 1][::-1])
                    best = (share, lo + end - start, lo + end)
            if best:
                out[item] = best
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that meet as one."""
    out = spans[:1]
    for lo, hi in spans[1:]:
        if lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def align(item: np.ndarray, doc: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment score, where it ends in ``doc``, and its matched
    words (of equal scores, the most). A row of the table at a time; gaps
    along the row by a running maximum."""
    n = len(doc)
    step = np.arange(n, dtype=np.int64) * (GAP * UNIT)
    above = np.zeros(n + 1, np.int64)
    best, end = 0, 0
    for w in item:
        here = np.maximum(above[:-1] + np.where(doc == w, MATCH * UNIT + 1, MISMATCH * UNIT), above[1:] - GAP * UNIT)
        np.maximum(here, 0, out=here)
        here = np.maximum.accumulate(here + step) - step
        here[here < UNIT] = 0  # a new alignment starts with no matches
        k = int(here.argmax()) if n else 0
        if n and here[k] > best:
            best, end = int(here[k]), k
        above[1:] = here
    return best // UNIT, end, best % UNIT


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str):
    """Blocks of test items, fetched one after the other, each of bounded
    size. An item larger than a block is a block."""
    rows, held = [], 0
    for r in benchmark.select(item_col, text_col).toLocalIterator():
        rows.append((r[0], r[1]))
        held += len(r[1] or "") + 16
        if held >= BLOCK_BYTES:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


def seeded(docs: DataFrame, rows: list, text_col: str) -> Items:
    """The block with its seeds chosen by counts over all documents."""
    items = Items(rows)

    def count(batches):
        total = np.zeros(len(items.grams), np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                key, _ = items.pairs(items.numbers(t))
                at = np.minimum(np.searchsorted(items.grams, key), len(items.grams) - 1)
                np.add.at(total, at[items.grams[at] == key], 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["g", "n"])

    counts = np.zeros(len(items.grams), np.int64)
    if len(items.grams):
        for r in docs.select(text_col).mapInArrow(released(count), "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).collect():
            counts[r.g] = r.n  # at most one row a pair of the block
    items.choose_seeds(counts)
    return items


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document row and test item that it contains: ids,
    ``score`` (share of a perfect copy's score), and the first and last word
    of the best alignment in the document. Repeated rows are searched each;
    without documents or items there are no rows."""
    spark = docs.sparkSession
    ship(spark)
    kinds = docs.select(id_col).schema[0].dataType.simpleString(), benchmark.select(item_col).schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, score double, first_word long, last_word long"
    out = None
    for rows in item_blocks(benchmark, item_col, item_text):
        items = seeded(docs, rows, text_col)

        def search(batches, items=items):
            for b in batches:
                got = [(r, items.ids[i], *x) for r, t in enumerate(b.column(1).to_pylist()) for i, x in sorted(items.found(t).items())]
                cols = list(zip(*got)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cols[0], pa.int64())), *[pa.array(c) if len(c) else pa.array([], k) for c, k in zip(cols[1:], (pa.int64(), pa.float64(), pa.int64(), pa.int64()))]],
                                                 [id_col, item_col, "score", "first_word", "last_word"])

        part = docs.select(id_col, text_col).mapInArrow(released(search), schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that contain no test item; all rows
    where there are no items. Repeated rows are judged each."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)
    every = docs  # pairs are counted over the input, not behind the filters of the blocks before
    for rows in item_blocks(benchmark, item_col, item_text):
        items = seeded(every, rows, text_col)

        def clean(batches, items=items):
            for b in batches:
                yield b.filter(pa.array([not items.found(t) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(released(clean), docs.schema)
    return docs
