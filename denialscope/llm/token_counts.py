"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a word form a linked list; a heap holds the adjacent pairs that
some piece joins, best rank first and leftmost on ties. Popping a live pair
merges it and offers its two new neighbours. The count of a word is its
initial symbols minus its merges, plus what byte fallback adds for characters
without a piece; no identifiers are made.

The text is cut where no piece can cross: before a run of spaces and around
line feeds (both checked against the vocabulary, else the text stays whole).
Words repeat heavily, so each worker keeps the counts of words it has seen in
a map of at most ``CACHE_WORDS`` entries.

Nulls and empty texts count 0 tokens. Repeated rows are counted row by row.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

CACHE_WORDS = 600_000
SPACE = "▁"
TOKENIZER = "piece_bpe_32k.model"


class MergeCounter(dict):
    """word -> tokens, counted on the first request."""

    def __init__(self, model_file: str):
        super().__init__()
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        # rank: the best score first
        pieces = {sp.id_to_piece(i): -sp.get_score(i) for i in normal}
        for odd, cond in (("unused pieces", any(sp.is_unused(i) for i in range(n))),
                          ("a normalizer", sp.normalize(" 　ﬁ a\t ") != f"{SPACE}{SPACE}　ﬁ{SPACE}a\t{SPACE}"),
                          ("no byte pieces", not any(sp.is_byte(i) for i in range(n)))):
            if cond:
                raise ValueError(f"{model_file} has {odd}; merges alone do not give its counts")
        self.ranks = pieces
        self.chars = {p for p in pieces if len(p) == 1}
        self.cut_spaces = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.cut_lines = not any("\n" in p for p in pieces)
        self.line_feed = 1  # one byte piece
        self._units = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self.merged(word)
        if len(word) <= 64:
            self[word] = n
        return n

    def merged(self, word: str) -> int:
        ranks, n = self.ranks, len(word)
        count = n
        for c in word:
            if c not in self.chars:
                count += len(c.encode("utf-8", "surrogatepass")) - 1
        if n < 2:
            return count
        syms = list(word)
        heap = []
        for i in range(n - 1):
            r = ranks.get(word[i:i + 2])
            if r is not None:
                heap.append((r, i, 2))
        if not heap:
            return count
        heapq.heapify(heap)
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, size = pop(heap)
            left = syms[i]
            if not left:
                continue
            j = nxt[i]
            if j >= n or len(left) + len(syms[j]) != size:
                continue  # one side has changed since this pair was offered
            joined = left + syms[j]
            syms[i], syms[j] = joined, ""
            j = nxt[i] = nxt[j]
            count -= 1
            if j < n:
                prv[j] = i
                s = joined + syms[j]
                r = ranks.get(s)
                if r is not None:
                    push(heap, (r, i, len(s)))
            h = prv[i]
            if h >= 0:
                s = syms[h] + joined
                r = ranks.get(s)
                if r is not None:
                    push(heap, (r, h, len(s)))
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        if not self.cut_spaces:
            return self[SPACE + text]
        total = 0
        lines = (SPACE + text).split("\n") if self.cut_lines else [SPACE + text]
        for line in lines:
            if line:
                if SPACE + SPACE in line or line[-1] == SPACE:
                    total += sum(map(self.__getitem__, self._units.findall(line)))
                else:
                    first, *rest = line.split(SPACE)
                    if first:
                        total += self[first]
                    total += sum([self[SPACE + w] for w in rest])
        return total + (len(lines) - 1) * self.line_feed


@lru_cache(maxsize=2)
def counter(tokenizer: str) -> MergeCounter:
    """One per worker process; ``tokenizer`` is a name in the tokenizer
    package or a path that the workers can open."""
    import os
    if not os.path.isabs(tokenizer):
        import public_tokenizers
        tokenizer = str(public_tokenizers.path(tokenizer))
    return MergeCounter(tokenizer)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8) and ``n_tokens``."""
    ship(docs.sparkSession)

    def count(batches):
        c = counter(tokenizer)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([c.count(t) for t in b.column(2).to_pylist()], pa.int64())],
                ["id", "n_bytes", "n_tokens"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"),
                         F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                         F.col(text_col).alias("text"))
    return picked.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
