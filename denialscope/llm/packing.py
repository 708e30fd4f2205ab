"""Token-id output: documents packed into fixed-length rows.

Documents become token ids with an end id after each; a document longer than a
row is split into row-long pieces and a rest, so no token is lost. Pieces go,
longest first, to the fullest row that still has room (best-fit decreasing); a
segment tree over the free capacities finds that row.

Packing runs inside each task, over groups of about ``GROUP_TOKENS`` tokens in
the order of the input: nothing is shuffled, memory is bounded, a lost task is
repeated alone, and only the last group of a task has looser rows. Every input
row appears: null and empty texts as a lone end id, repeated rows once each.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

ROW, END, PAD = 2048, 50256, 50256
TOKENIZER = "byte_bpe_50k.tiktoken"
GROUP_TOKENS = 4 << 20
CHUNK = 256


class Capacities:
    """Segment tree over free capacities 0..size: how many open rows have
    each, and the rows themselves."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, n: int) -> None:
        k = capacity + self.leaves
        while k:
            self.count[k] += n
            k >>= 1

    def put(self, row: int, capacity: int) -> None:
        self.rows[capacity].append(row)
        self._add(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """An open row of the smallest capacity >= need, with that capacity."""
        k = need + self.leaves
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):  # up until a right neighbour has rows
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:
                k *= 2
                if not self.count[k]:
                    k += 1
        capacity = k - self.leaves
        row = self.rows[capacity].pop()
        self._add(capacity, -1)
        return row, capacity


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of piece numbers; lengths are 1..size."""
    tree, rows = Capacities(size), []
    for piece in sorted(range(len(lengths)), key=lambda p: (-lengths[p], p)):
        got = tree.take(lengths[piece])
        if got is None:
            got = len(rows), size
            rows.append([])
        row, capacity = got
        rows[row].append(piece)
        if capacity > lengths[piece]:
            tree.put(row, capacity - lengths[piece])
    return rows


@lru_cache(maxsize=2)
def encoding(tokenizer: str):
    import os

    import public_tokenizers
    import tiktoken
    path = tokenizer if os.path.isabs(tokenizer) else public_tokenizers.path(tokenizer)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(docs: list[tuple], size: int, pad: int, dtype) -> list[dict]:
    """Rows for a group of (id, ids) documents."""
    pieces = [(d, k) for d, (_, ids) in enumerate(docs) for k in range(0, len(ids), size)]
    lengths = [min(size, len(docs[d][1]) - k) for d, k in pieces]
    out = []
    for members in best_fit(lengths, size):
        ids = np.full(size, pad, dtype)
        pos = np.zeros(size, np.uint32 if size > 1 << 16 else np.uint16)
        ends = [0]
        for p in members:
            d, k = pieces[p]
            a, b = ends[-1], ends[-1] + lengths[p]
            ids[a:b] = docs[d][1][k:k + lengths[p]]
            pos[a:b] = np.arange(lengths[p])
            ends.append(b)
        out.append({"doc_ids": [docs[pieces[p][0]][0] for p in members], "offsets": [pieces[p][1] for p in members],
                    "cu_seqlens": ends, "n_tokens": ends[-1], "ids": ids.tobytes(), "positions": pos.tobytes()})
    return out


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = ROW,
                   tokenizer: str = TOKENIZER, end: int = END, pad: int = PAD, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One output row per packed row: ``row_id``; ``ids`` (``size`` little
    endian unsigned numbers of 2 bytes, 4 for a larger vocabulary), padded
    after the last segment; ``cu_seqlens``; ``positions`` (restarting from 0
    in every segment); and for each segment the id of its document and its
    first token's offset there."""
    ship(docs.sparkSession)

    def run(batches):
        enc = encoding(tokenizer)
        dtype = np.uint16 if max(enc.max_token_value, end, pad) < 1 << 16 else np.uint32
        schema = None

        def rows(group):
            return pa.RecordBatch.from_pylist(packed(group, size, pad, dtype), schema)

        group, held = [], 0
        for b in batches:
            schema = pa.schema([("doc_ids", pa.list_(b.schema.field(0).type)), ("offsets", pa.list_(pa.int64())), ("cu_seqlens", pa.list_(pa.int32())),
                                ("n_tokens", pa.int32()), ("ids", pa.binary()), ("positions", pa.binary())])
            for k in range(0, b.num_rows, CHUNK):
                for i, t in zip(b.column(0).slice(k, CHUNK).to_pylist(), b.column(1).slice(k, CHUNK).to_pylist()):
                    ids = np.array(enc.encode_ordinary(t or "") + [end], dtype)
                    group.append((i, ids))
                    held += len(ids)
                    if held >= group_tokens:
                        yield rows(group)
                        group, held = [], 0
        if group:
            yield rows(group)

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    got = picked.mapInArrow(run, f"doc_ids array<{kind}>, offsets array<long>, cu_seqlens array<int>, n_tokens int, ids binary, positions binary")
    return got.select(F.monotonically_increasing_id().alias("row_id"), "*")


def matrix(column: list[bytes], size: int, dtype=np.uint16) -> np.ndarray:
    """(rows, size) matrix of ids or positions read back."""
    return np.frombuffer(b"".join(column), dtype).reshape(-1, size)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Packed rows as Parquet with binary columns."""
    pack_documents(docs, **options).write.parquet(path)
