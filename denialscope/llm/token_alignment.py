"""Alignment of two tokenizers' tokens, by lockstep merging.

1. Every text is encoded by a byte-level BPE (A) and a piece model (B). Both
   cut the same bytes (a space and the text) into tokens; where a text's bytes
   don't come back joined from either side, it has no tokens.
2. Lockstep: documents become lanes of ``LANE`` consecutive A tokens, and one
   state vector holds every lane's pointer into A and into B. A step links the
   two tokens that each lane points at, whose bytes overlap; the side whose
   token ends first moves on, both where they end together, which is a cut.
   Finished lanes leave the vector. A lane starts in B at the token that holds
   its first byte, so every link belongs to the lane of its A token and long
   documents take no longer than short ones.
3. What is linked goes into blocks of at most ``BLOCK_TOKENS`` A tokens (or one
   document): a block's row lists its id pairs and in how many of its documents
   each is linked; a document's row points into that list.
4. Pairs are counted over all blocks (partial sums first), the highest count of
   each A id is found, and both go back to the blocks that have the pair: a row
   a block, never one a document. A pair that occurs everywhere is a row a
   block too, and its one count row meets them in a plain join.
5. Each block's documents meet the block's counts and sum up their links.

Null and empty texts have no tokens. Repeated rows count as documents of their
own. Very long texts are encoded whole. The result has one row an input row,
whatever other columns there are; an empty table gives none. Strings of special
tokens inside a text are plain text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import released, ship, small_batches, written

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
LANE = 256
BLOCK_TOKENS = 1 << 20
ENCODE_ROWS = 64
#: A pair of ids as one number: A times this plus B.
WIDTH = 1 << 20

ALIGNED = ("kind byte, block long, id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, docs array<int>, at array<int>, times array<int>")


def _path(name: str) -> str:
    import os
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return str(public_tokenizers.path(name))


def byte_characters() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands
    for itself, the other bytes for the characters from U+0100 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBPE:
    """Ids of a byte-level BPE file. Where the file's ids are its merge ranks,
    texts are encoded by rank with the same split pattern, which gives the same
    ids in a seventh of the time; else, and where that fails, by the file's own
    library."""

    #: Runs without white space, or of nothing else, that are left to the file's own library.
    RUN = r"\S{4096}|\s{4096}"

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer
        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        with open(path) as f:
            spec = json.load(f)
        to_byte = byte_characters()
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = {i: (k.encode() if k in special else bytes(to_byte[c] for c in k)) for k, i in (vocab | special).items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ranked = all(vocab[a + b] == 256 + k for k, (a, b) in enumerate(merges)) and len(vocab) == 256 + len(merges)
        split = spec["pre_tokenizer"] or {}
        self.fast, self.long_run = None, re.compile(self.RUN)
        if ranked and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not spec["normalizer"]:
            import public_tokenizers
            import tiktoken
            ranks = {self.bytes[i]: i for k, i in vocab.items() if k not in special}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        slow = []
        for k, t in enumerate(texts):
            if self.fast is None or self.long_run.search(t):
                slow.append(k)
            else:
                out[k] = self.fast.encode_ordinary(t)
        for k, e in zip(slow, self.own.encode_batch_fast([texts[k] for k in slow], add_special_tokens=False) if slow else ()):
            out[k] = e.ids
        return out


class PieceModel:
    """Ids of a piece model; it puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        def one(i):
            piece = self.own.id_to_piece(i)
            if self.own.is_byte(i):
                return bytes([int(piece[1:-1], 16)])
            return piece.replace("▁", " ").encode()
        self.bytes = {i: one(i) for i in range(self.own.get_piece_size())}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.own.encode_as_numpy(texts, num_threads=1)


def _joined(table: pa.Array, places: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Entries of a table of strings one after the other, and where each begins
    (at last, where the last one ends)."""
    if not len(places):
        return b"", np.zeros(1, np.int64)
    _, at, data = table.take(pa.array(places, pa.int64())).buffers()
    return data.to_pybytes() if data else b"", np.frombuffer(at, np.int64)[:len(places) + 1]


class Vocabulary:
    """An encoder with its tokens' bytes, their lengths, and ids as text: first
    each with a comma, then each with the mark that ends a group's tokens."""

    def __init__(self, encoder, mark: str):
        self.encode = encoder.encode
        self.size = max(encoder.bytes) + 1
        self.bytes = pa.array([encoder.bytes.get(i, b"") for i in range(self.size)], pa.large_binary())
        self.length = np.array([len(encoder.bytes.get(i, b"")) for i in range(self.size)], np.int64)
        self.written = pa.array([f"{i}{end}".encode() for end in (",", mark) for i in range(self.size)], pa.large_binary())


@lru_cache(maxsize=2)
def vocabularies(byte_bpe: str, pieces: str) -> tuple[Vocabulary, Vocabulary]:
    """One pair per worker process; names in the tokenizer package or paths."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Vocabulary(ByteBPE(_path(byte_bpe)), "|"), Vocabulary(PieceModel(_path(pieces)), ";")


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, lane: int = LANE):
    """Links and cuts of documents whose tokens stand one after the other.

    ``ends_*``: byte at which each token ends, running on over all documents
    (the last tokens of a document end together); ``first_*``: place of each
    document's first token, and the total at the end. Returns (a, b) places of
    all linked tokens and the places in A and B of tokens before a cut, in no
    particular order."""
    lanes = [np.arange(s, e, lane) for s, e in zip(first_a[:-1], first_a[1:])]
    a = np.concatenate(lanes) if lanes else np.empty(0, np.int64)
    until = np.minimum(a + lane, np.repeat(first_a[1:], [len(x) for x in lanes]))
    starts = np.concatenate([[0], ends_a])
    b = np.searchsorted(ends_b, starts[a], side="right")
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        cut = end_a == end_b
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        alive = a < until
        if not alive.all():
            a, b, until = a[alive], b[alive], until[alive]
    whole = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return whole(links_a), whole(links_b), whole(cuts_a), whole(cuts_b)


def group_texts(va: Vocabulary, vb: Vocabulary, ids_a, ids_b, first_a, first_b, cuts_a, cuts_b) -> list[bytes]:
    """For each document ``a1,a2|b1;a3|b2,b3``: the ids of each group."""
    cut_a, cut_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    cut_a[cuts_a] = 1
    cut_b[cuts_b] = 1
    # groups before each token, and the tokens of the other side in them
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    n = len(cuts_a)
    count_a, count_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    before_b, upto_a = np.cumsum(count_b) - count_b, np.cumsum(count_a)
    out = np.empty(len(ids_a) + len(ids_b), np.int64)
    if len(ids_a):
        out[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + cut_a * va.size
    if len(ids_b):
        out[np.arange(len(ids_b)) + upto_a[group_b]] = ids_b + cut_b * vb.size + 2 * va.size
    text, at = _joined(pa.concat_arrays([va.written, vb.written]), out)
    ends = at[first_a + first_b].tolist()
    return [text[s:e - 1] if e > s else b"" for s, e in zip(ends[:-1], ends[1:])]


def encode_pair(va: Vocabulary, vb: Vocabulary, texts: list[str | None]):
    """Ids of both sides, document by document, as (all ids, first places)."""
    first = lambda n: np.concatenate([[0], np.cumsum(np.array(n, np.int64))])
    got: tuple = ([], [], [], [])
    for k in range(0, len(texts), ENCODE_ROWS):
        part = [t or "" for t in texts[k:k + ENCODE_ROWS]]
        whole = [(" " + t).encode() for t in part]
        right = np.array([t != "" for t in part])
        sides = []
        for v, own in ((va, [" " + t for t in part]), (vb, part)):
            lists = v.encode(own)
            n = np.array([len(x) for x in lists], np.int64)
            ids = np.concatenate(lists).astype(np.int64) if isinstance(lists[0], np.ndarray) else np.fromiter(chain.from_iterable(lists), np.int64, n.sum())
            data, at = _joined(v.bytes, ids)
            ends = at[first(n)].tolist()
            right &= [data[s:e] == w for s, e, w in zip(ends[:-1], ends[1:], whole)]
            sides.append((ids, n))
        for side, (ids, n) in enumerate(sides):
            got[side].append(ids[np.repeat(right, n)])
            got[2 + side].append(n * right)
    none = [np.empty(0, np.int64)]
    ids_a, ids_b, n_a, n_b = (np.concatenate(x or none) for x in got)
    return ids_a, ids_b, first(n_a), first(n_b)


def align(va: Vocabulary, vb: Vocabulary, ids_a, ids_b, first_a, first_b) -> dict:
    """Groups and links of encoded documents: per document the numbers and the
    groups' digest; over all of them the distinct id pairs, in how many
    documents each is linked, and each document's pairs as places in that list
    with the number of links."""
    n = len(first_a) - 1
    link_a, link_b, cuts_a, cuts_b = lockstep(np.cumsum(va.length[ids_a]), np.cumsum(vb.length[ids_b]), first_a, first_b)
    cuts_a, cuts_b = np.sort(cuts_a), np.sort(cuts_b)
    texts = group_texts(va, vb, ids_a, ids_b, first_a, first_b, cuts_a, cuts_b)
    filled = np.flatnonzero(np.diff(first_a))  # at most BLOCK_TOKENS of them: their places and a pair are one number
    doc = np.searchsorted(first_a[filled], link_a, side="right") - 1
    own, times = np.unique(doc * WIDTH**2 + (ids_a[link_a] * WIDTH + ids_b[link_b]), return_counts=True)
    pairs, at = np.unique(own % WIDTH**2, return_inverse=True)
    doc, own_doc = filled[doc], filled[own // WIDTH**2]
    return {"n_a": np.diff(first_a), "n_b": np.diff(first_b), "n_links": np.bincount(doc, minlength=n),
            "n_groups": np.diff(np.searchsorted(cuts_a, first_a)),
            "groups_sha256": [hashlib.sha256(t).hexdigest() if t else "" for t in texts], "groups": texts,
            "pairs": pairs, "docs": np.bincount(at, minlength=len(pairs)),
            "at": at, "times": times, "first": np.searchsorted(own_doc, np.arange(n + 1))}


def _list_of(values: np.ndarray, first: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def aligned_blocks(batches: Iterable[pa.RecordBatch], byte_bpe: str, pieces: str) -> Iterable[pa.RecordBatch]:
    """Rows of ``ALIGNED`` for batches of (id, text): kind 1 a document, kind 0
    a block."""
    from pyspark import TaskContext
    va, vb = vocabularies(byte_bpe, pieces)
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids_a, ids_b, first_a, first_b = encode_pair(va, vb, batch.column(1).to_pylist())
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(first_a, first_a[start] + BLOCK_TOKENS, side="right")) - 1)
            sa, sb = slice(first_a[start], first_a[stop]), slice(first_b[start], first_b[stop])
            got = align(va, vb, ids_a[sa], ids_b[sb], first_a[start:stop + 1] - first_a[start], first_b[start:stop + 1] - first_b[start])
            n = stop - start
            none = lambda kind, rows=n: pa.nulls(rows, kind)
            longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
            shift = np.diff(got["at"], prepend=0)  # places as steps from the one before: small numbers
            heads = got["first"][:-1][np.diff(got["first"]) > 0]
            shift[heads] = got["at"][heads]
            names = ["kind", "block", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "docs", "at", "times"]
            numbers = [pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * n, pa.int8()), pa.array([block] * n, pa.int64()), batch.column(0).slice(start, n), *numbers, pa.array(got["groups_sha256"], pa.string()),
                 none(longs), none(ints), _list_of(shift, got["first"], pa.int32()), _list_of(got["times"], got["first"], pa.int32())], names)
            if len(got["pairs"]):
                one = lambda v, kind: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0], pa.int8()), pa.array([block], pa.int64()), pa.nulls(1, batch.schema.field(0).type), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()),
                     one(got["pairs"], pa.int64()), one(got["docs"], pa.int32()), none(ints, 1), none(ints, 1)], names)
            block += 1
            start = stop


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked), best (the highest n of a pair
    with its A id)."""
    rows = aligned.where("kind = 0").select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = rows.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n"))
    # an A id has at most as many pairs as B has ids
    return counts.withColumn("best", F.max("n").over(Window.partitionBy(F.expr(f"pair div {WIDTH}"))))


def _sums(counts, docs):
    """For a cogroup: a block's documents and the counts of its pairs."""
    place = counts["place"].to_numpy()
    n = np.zeros(int(place.max()) + 1 if len(place) else 0, np.int64)
    best = np.zeros(len(n), np.int64)
    n[place], best[place] = counts["n"].to_numpy(), counts["best"].to_numpy()
    at, times = docs["at"].combine_chunks(), docs["times"].combine_chunks()
    first = at.offsets.to_numpy()
    first = first - first[0]
    step, times = at.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy().astype(np.int64)
    run = np.cumsum(step)
    length = np.diff(first)
    base = np.concatenate([[0], run])[first[:-1]]
    place = run - np.repeat(base, length)
    cum = lambda v: np.concatenate([[0], np.cumsum(v)])
    total, top = cum(n[place] * times), cum((n[place] == best[place]) * times)
    return pa.table({c: docs[c] for c in ("id", "n_a", "n_b", "n_groups", "n_links")}
                    | {"n_best": pa.array(top[first[1:]] - top[first[:-1]]), "count_sum": pa.array(total[first[1:]] - total[first[:-1]]),
                       "groups_sha256": docs["groups_sha256"]})


def token_alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """One row per input row: its id, numbers of tokens, groups and links, how
    many links are their A id's most frequent, the sum of the links' counts,
    and the digest of the groups."""
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = picked.schema[0].dataType.simpleString()

    def run(batches):
        return aligned_blocks(batches, byte_bpe, pieces)

    aligned = written(picked.mapInArrow(released(run), ALIGNED.format(id=kind)), "token-alignment")
    held = aligned.where("kind = 0").select("block", F.posexplode("pairs").alias("place", "pair"))
    met = held.join(pair_counts(aligned), "pair").select("block", "place", "n", "best")
    rows = aligned.where("kind = 1").select("block", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "times")
    rows = rows.withColumnRenamed("block", "of_block")
    summed = met.groupBy("block").cogroup(rows.groupBy("of_block")).applyInArrow(
        _sums, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return summed.withColumnRenamed("id", id_col)
