"""Piece encoding and decoding with a relational lattice.

The text, with a space (``▁`` in the pieces) in front, is cut into words
wherever no piece has the two neighbouring characters side by side, so no
piece can cross a cut and the best segmentation is that of the words. Then, in
DataFrame operations over the distinct words of the corpus:

1. every substring of at most the longest piece's length is exploded,
2. an equi-join to the piece table (bounded: one row a piece) keeps the edges;
   a single character without a piece is an edge spelt by its byte pieces,
3. edges are grouped by word and folded in order of their ends with
   ``aggregate``: Viterbi, the best sum of scores up to every position; of
   equal sums the longer last piece wins.

The ids of the words return to the documents block by block. A word of over
``MAX_WORD`` characters would make too large a group: the same fold runs over
it where its document is, keeping the best scores of the last places only and
one edge a place, so that its ids too are those of the best segmentation.

Null and empty texts have no pieces. Repeated rows are encoded each.
"""

from __future__ import annotations

from array import array
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import blocked, document_chunks, meet, word_chunks
from .common import released, ship, small_batches

TOKENIZER = "piece_bpe_32k.model"
SPACE = "▁"
MAX_WORD = 256
UNKNOWN_PENALTY = 10.0
FLUSH_WORDS = 1 << 19  # distinct words that a worker holds


class Pieces:
    """What the cutting and the decoding need of the vocabulary."""

    def __init__(self, model_file: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.rows, self.text, self.first_byte = [], [b""] * n, None
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.text[i] = bytes([value])
                if self.first_byte is None:
                    self.first_byte = i - value
                elif self.first_byte != i - value:
                    raise ValueError("byte pieces are not in order")
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.rows.append((piece, i, float(sp.get_score(i))))
                self.text[i] = piece.replace(SPACE, " ").encode()
        if self.first_byte is None:
            raise ValueError("the vocabulary has no byte pieces")
        pieces = [p for p, _, _ in self.rows]
        self.longest = max(map(len, pieces))
        self.unknown = min(s for _, _, s in self.rows) - UNKNOWN_PENALTY
        # which characters stand side by side in some piece; 0: in no piece
        chars = sorted(set("".join(pieces)))
        self._kinds = len(chars) + 1
        self._char = np.zeros(0x110000, np.int32)
        self._char[[ord(c) for c in chars]] = np.arange(1, self._kinds)
        self._char[ord(" ")] = self._char[ord(SPACE)]
        near = np.zeros((self._kinds, self._kinds), bool)
        for x, y in {x + y for piece in pieces for x, y in zip(piece, piece[1:])}:
            near[self._char[ord(x)], self._char[ord(y)]] = True
        self._apart = ~near.ravel()
        first = self._char[:256]  # the same for texts whose characters fit in a byte
        self._apart_byte = self._apart[(first[:, None] * self._kinds + first[None, :]).ravel()]
        self.width = np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
        ends = np.cumsum([0, *map(len, self.text)])
        self._bytes, self._start, self._size = np.frombuffer(b"".join(self.text), np.uint8), ends[:-1], np.diff(ends)

    @cached_property
    def known(self) -> dict[str, tuple[int, float]]:
        return {piece.replace(SPACE, " "): (i, score) for piece, i, score in self.rows}

    def words(self, text: str | None) -> list[str]:
        return self.cut(text)[0]

    def cut(self, text: str | None) -> tuple[list[str], int]:
        """The text, with a space in front, cut wherever no piece has both
        neighbours; a space stands for ``▁``. And the longest word's length."""
        if not text:
            return [], 0
        text = " " + text.replace(SPACE, " ")
        try:
            k = np.frombuffer(text.encode("latin-1"), np.uint8).astype(np.uint16)
            cut = self._apart_byte[k[:-1] * np.uint16(256) + k[1:]]
        except UnicodeEncodeError:
            k = self._char[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
            cut = self._apart[k[:-1] * self._kinds + k[1:]]
        stop = np.append(np.flatnonzero(cut) + 1, len(k))
        at = stop.tolist()
        return [text[x:y] for x, y in zip([0, *at], at)], int(np.diff(stop, prepend=0).max())

    def best_path(self, word: str) -> list[int]:
        """The ids of a word, like ``best_paths``, in time that grows with its
        length and with a back pointer a character."""
        known, longest = self.known, self.longest
        scores = [0.0]  # of the last places, at most ``longest``
        back_id, back_size = array("i"), array("i")
        for end in range(1, len(word) + 1):
            best = None
            for n in range(len(scores), 0, -1):
                edge = known.get(word[end - n:end])
                if edge is None:
                    if n > 1:
                        continue
                    edge = (-1, self.unknown)
                score = scores[-n] + edge[1]
                if best is None or score > best:
                    best, piece, size = score, edge[0], n
            back_id.append(piece)
            back_size.append(size)
            scores.append(best)
            if len(scores) > longest:
                del scores[0]
        out, end = [], len(word)
        while end:
            piece = back_id[end - 1]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.first_byte + v for v in reversed(word[end - 1].encode()))
            end -= back_size[end - 1]
        return out[::-1]

    def spelt(self, ids: np.ndarray) -> bytes:
        """The bytes of the pieces, one after the other."""
        size = self._size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self._bytes[np.repeat(self._start[ids] - (ends - size), size) + np.arange(total)].tobytes()

    def decode(self, ids) -> str:
        """The text that the ids spell, without the space in front."""
        return self.spelt(np.asarray(ids, np.int64))[1:].decode("utf-8", "replace")


@lru_cache(maxsize=2)
def pieces(tokenizer: str) -> Pieces:
    import os
    if not os.path.isabs(tokenizer):
        import public_tokenizers
        tokenizer = str(public_tokenizers.path(tokenizer))
    return Pieces(tokenizer)


def block_words(rows: DataFrame, tokenizer: str) -> DataFrame:
    """(word, block): a block's distinct words of at most ``MAX_WORD``
    characters."""
    def run(batches):
        p = pieces(tokenizer)
        words, block = set(), None

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array([block] * len(words), pa.int64())], ["word", "block"])
            words.clear()
            return batch

        for b in batches:
            for at, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if block != at or len(words) > FLUSH_WORDS:
                    if words:
                        yield out()
                    block = at
                got, most = p.cut(text)
                words.update(got if most <= MAX_WORD else [w for w in got if len(w) <= MAX_WORD])
        if words:
            yield out()
    return rows.select("block", "text").mapInArrow(released(run), "word string, block long")


def piece_table(spark: SparkSession, tokenizer: str) -> DataFrame:
    rows = [(p.replace(SPACE, " "), i, score) for p, i, score in pieces(tokenizer).rows]
    if len({xxhash.xxh64_intdigest(p, 42) for p, _, _ in rows}) < len(rows):
        raise ValueError("two pieces share a hash")
    return spark.createDataFrame(rows, "own string, id int, score double").withColumn("hash", F.xxhash64("own"))


def best_paths(words: DataFrame, table: DataFrame, p: Pieces) -> DataFrame:
    """(word, blocks, ids) of ``words(word, block)``; a block may be listed
    more than once for a word."""
    # one of a word's rows is exploded, whichever comes first; the others only
    # carry a block
    turn = F.row_number().over(Window.partitionBy("word").orderBy("word"))
    end, n = F.col("end"), F.col("n")
    rows = words.withColumn("turn", turn).select("word", "block", F.explode(
        F.when(F.col("turn") == 1, F.sequence(F.lit(1), F.length("word"))).otherwise(F.array(F.lit(0)))).alias("end"))
    longest = F.least(F.lit(p.longest), end)
    rows = rows.select("word", "block", "end", F.explode(
        F.when(end > 0, F.sequence(longest, F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(0)))).alias("n"))
    rows = rows.select("word", "block", "end", "n", F.when(end > 0, F.col("word").substr(end - n + 1, n)).alias("piece"))
    # the piece table has one row a piece of a given vocabulary; equal pieces
    # have equal hashes, and a number is the faster key
    edges = rows.withColumn("hash", F.xxhash64("piece")).join(F.broadcast(table), "hash", "left")
    known = F.col("own") == F.col("piece")
    edges = edges.where(known | (n <= 1))
    # a character that is no piece has id -1; edges come in the order of
    # (end, start), so that sorting has little to do
    edge = F.when(end > 0, F.struct("end", (end - n).alias("start"), F.when(known, F.col("id")).otherwise(-1).alias("id"),
                                    F.when(known, F.col("score")).otherwise(p.unknown).alias("score")))
    block = F.when(end <= 1, F.col("block"))
    grouped = edges.select("word", edge.alias("edge"), block.alias("block")).groupBy("word").agg(
        F.sort_array(F.collect_list("edge")).alias("edges"), F.collect_list("block").alias("blocks"))

    def fold(best, e):
        came = F.get(best, e["start"])
        score = came["score"] + e["score"]
        # a character that is no piece is noted by its place
        step = F.array(F.struct(score.alias("score"), F.concat(came["path"], F.array(F.when(e["id"] >= 0, e["id"]).otherwise(-e["end"]))).alias("path")))
        return (F.when(F.size(best) == e["end"], F.concat(best, step))
                .when(score > F.element_at(best, -1)["score"], F.concat(F.slice(best, F.lit(1), e["end"]), step)).otherwise(best))

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("path")))
    paths = grouped.select("word", "blocks", F.aggregate("edges", first, fold, lambda b: F.element_at(b, -1)["path"]).alias("path"))

    def spelt(place):
        code = F.hex(F.encode(F.col("word").substr(-place, F.lit(1)), "UTF-8"))
        return F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda k: F.conv(F.substring(code, k, F.lit(2)), 16, 10).cast("int") + p.first_byte)

    ids = F.flatten(F.transform("path", lambda x: F.when(x >= 0, F.array(x)).otherwise(spelt(x))))
    return paths.select("word", "blocks", F.when(F.exists("path", lambda x: x < 0), ids).otherwise(F.col("path")).alias("ids"))


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per input row: id, ``ids`` (array of int), ``n_pieces``, and
    ``round_trip``: whether decoding the ids gives the text back (``▁`` in a
    text comes back as a space)."""
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    p = pieces(tokenizer)
    rows = blocked(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    words = best_paths(block_words(rows, tokenizer), piece_table(spark, tokenizer), p)

    def load(parts):
        own, width = pieces(tokenizer), pieces(tokenizer).width
        known = {}
        for part in parts:
            ids = part.column(1)
            data = ids.flatten().to_numpy().astype(width).tobytes()
            ends = (np.cumsum(pa.compute.list_value_length(ids).to_numpy()) * width.itemsize).tolist()
            known.update(zip(part.column(0).to_pylist(), (data[a:b] for a, b in zip([0, *ends], ends))))

        return known

    def apply(known, chunk):
        own = pieces(tokenizer)
        texts = chunk.column(1).to_pylist()

        def ids_of(t):
            words, most = own.cut(t)
            if most <= MAX_WORD:
                return b"".join(map(known.__getitem__, words))
            return b"".join(known[w] if len(w) <= MAX_WORD else np.array(own.best_path(w), own.width).tobytes() for w in words)

        got = [np.frombuffer(ids_of(t), own.width) for t in texts]
        ends = np.cumsum([0, *map(len, got)])
        flat = np.concatenate(got).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        same = [own.spelt(g)[1:] == (t or "").replace(SPACE, " ").encode() for g, t in zip(got, texts)]
        return pa.RecordBatch.from_arrays([chunk.column(0), ids, pa.array(np.diff(ends), pa.int64()), pa.array(same)], ["id", "ids", "n_pieces", "round_trip"])

    kind = rows.schema["id"].dataType.simpleString()
    got = meet(document_chunks(rows), word_chunks(words, lambda b: [b.column("ids")], ["ids"]), load, apply,
               f"id {kind}, ids array<int>, n_pieces long, round_trip boolean")
    return got.withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, text) of encoded rows; null ids give a null text."""
    ship(encoded.sparkSession)

    def run(batches):
        own = pieces(tokenizer)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else own.decode(x) for x in b.column(1).to_pylist()], pa.string())], ["id", "text"])

    picked = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)
