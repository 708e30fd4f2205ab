"""Per-word results carried back to documents, block by block.

A block is a stretch of rows of one input file, so it is the same in every
pass whatever the partitioning. One pass lists each block's distinct words;
what is found out about a word (in a table with one row a word) comes back as
compressed chunks of (word, values) for each block, and meets the block's
documents there. A word that occurs everywhere is one row a block, never one
a document, and a task holds the dictionary of one block at a time while its
documents stream by.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, ship, written

BLOCK_ROWS = 1 << 14
CHUNK_ROWS, CHUNK_BYTES = 512, 4 << 20
SCHEMA = "block long, kind byte, data binary"
_FIELDS = pa.schema([("block", pa.int64()), ("kind", pa.int8()), ("data", pa.binary())])


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def gathered(batches: Iterable[pa.RecordBatch], rows: int = 10_000) -> Iterable[pa.RecordBatch]:
    """Batches of at least ``rows`` narrow rows, whatever Spark's batch size."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def blocked(rows: DataFrame) -> DataFrame:
    """``rows`` and their ``block``. Rows that are not read straight from
    Parquet are written to the shared folder first."""
    def add(df):
        place = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / BLOCK_ROWS))
        return df.select(*[F.col(f"`{c}`") for c in rows.columns], place.alias("block"))
    try:
        return add(rows)
    except AnalysisException:
        return add(written(rows, "blocks"))


def document_chunks(rows: DataFrame) -> DataFrame:
    """(block, kind 1, data): whole rows of ``rows(block, id, text)`` in
    compressed chunks."""
    def run(batches):
        for b in batches:
            block, text = b.column(0).to_numpy(), b.column(2)
            start, held = 0, 0
            sizes = pa.compute.fill_null(pa.compute.binary_length(text), 0).to_pylist()
            for k in range(b.num_rows):
                held += sizes[k]
                if k + 1 == b.num_rows or block[k + 1] != block[k] or k + 1 - start >= CHUNK_ROWS or held >= CHUNK_BYTES:
                    part = pa.RecordBatch.from_arrays([b.column(1).slice(start, k + 1 - start), text.slice(start, k + 1 - start)], ["id", "text"])
                    yield pa.RecordBatch.from_arrays([pa.array([int(block[k])]), pa.array([1], pa.int8()), pa.array([packed(part)], pa.binary())], schema=_FIELDS)
                    start, held = k + 1, 0
    return rows.select("block", "id", "text").mapInArrow(released(run), SCHEMA)


def word_chunks(words: DataFrame, values: Callable[[pa.RecordBatch], list[pa.Array]], names: list[str], flush: int = 100_000) -> DataFrame:
    """(block, kind 0, data): for each block, chunks of (word, values) of
    ``words(word, blocks, ...)``. ``values`` adds columns to a batch."""
    def run(batches):
        held: dict[int, list] = {}
        n = 0

        def out():
            for block, parts in held.items():
                t = pa.Table.from_batches(parts).combine_chunks().to_batches()
                for part in t:
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([0], pa.int8()), pa.array([packed(part)], pa.binary())], schema=_FIELDS)

        for b in gathered(batches):
            row = pa.RecordBatch.from_arrays([b.column("word"), *values(b)], ["word", *names])
            blocks = b.column("blocks")
            at = pa.compute.list_parent_indices(blocks)
            flat = blocks.flatten()
            order = pa.compute.array_sort_indices(flat)
            flat, at = flat.take(order).to_numpy(), at.take(order)
            cut = [0, *((flat[1:] != flat[:-1]).nonzero()[0] + 1).tolist(), len(flat)] if len(flat) else []
            for a, z in zip(cut, cut[1:]):
                held.setdefault(int(flat[a]), []).append(row.take(at.slice(a, z - a)))
            n += len(flat)
            if n >= flush:
                yield from out()
                held, n = {}, 0
        yield from out()
    return words.mapInArrow(released(run), SCHEMA)


def meet(documents: DataFrame, words: DataFrame, load: Callable[[Iterable[pa.RecordBatch]], object],
         apply: Callable[[object, pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Bring the chunks of both kinds together: ``load`` makes a block's
    dictionary of its word chunks, ``apply`` turns a chunk of documents into
    result rows."""
    ship(documents.sparkSession)

    def run(batches):
        block, parts, state = None, [], None
        for b in batches:
            for at, kind, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if at != block:
                    block, parts, state = at, [], None
                chunk = unpacked(data.as_buffer())
                if kind == 0:
                    parts.append(chunk)
                else:
                    if state is None:
                        state = load(parts)
                        parts = []
                    yield apply(state, chunk)

    both = documents.unionByName(words)
    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(released(run), schema)
