"""Registered training-data queries (``opN_<name>`` and ``pipeline``)."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from .common import documents, id_remainder
from .decontaminate import contaminated
from .language_id import predict_language, train_language_id
from .lattice_lm import lattice_scores
from .line_crf import line_quality, train_line_crf
from .merkle import as_text, merkle_manifest, proof_digest, proofs, record_digest, verified
from .nearest import nearest_neighbours
from .packing import pack_documents
from .piece_lattice import encode_documents
from .sharding import assign_shards
from .simhash import hex_fingerprint, simhash_components
from .token_alignment import token_alignment
from .token_counts import token_counts
from .weak_quality import weak_quality

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
TOKEN_LIMIT = 4096
QUALITY_CUT = 0.3


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_token_counts(spark, sf_dir):
    """Tokens of every document; over_limit: more than 4096 of them."""
    return token_counts(documents(spark, sf_dir)).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op3_simhash_components(spark, sf_dir):
    """SimHash classes of all documents: 3-word shingles, at most 3 bits."""
    got = simhash_components(documents(spark, sf_dir))
    return got.select("doc_id", hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query
def op10_weak_quality(spark, sf_dir):
    """Quality rules over all documents, combined by weak supervision."""
    got = weak_quality(documents(spark, sf_dir), columns=["doc_id"])
    q = F.col("_quality")
    return got.select("doc_id", *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")])


@query
def op6_language_id(spark, sf_dir):
    """Language of every document, learned where crc32(doc_id) mod 4 is not 2."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held = id_remainder(F.col("doc_id"), 4) == 2
    model = train_language_id(docs.where(~held))
    got = predict_language(docs.select("doc_id", "text"), model)
    return got.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op8_line_crf(spark, sf_dir):
    """Quality of every document, learned where crc32(doc_id) mod 5 is not 0."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held = id_remainder(F.col("doc_id"), 5) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = train_line_crf(docs, labels.where(~held))
    got = line_quality(docs, model)
    return got.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


@query
def op1_sampled_shards(spark, sf_dir):
    """All documents in 40 shards of nearly equal bytes; equal texts adjoin."""
    text = F.coalesce(F.col("text"), F.lit(""))
    records = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"))
    got = assign_shards(records, "key", "doc_id", "size")
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op5_decontaminate(spark, sf_dir):
    """Documents that contain a benchmark item, exact or edited."""
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op7_packed_rows(spark, sf_dir):
    """All documents as packed rows of 2,048 token ids."""
    return pack_documents(documents(spark, sf_dir))


@query
def op2_subword_lattice(spark, sf_dir):
    """Log10 probability of every document, learned where crc32(doc_id) mod 7
    is not 2."""
    held = id_remainder(F.col("doc_id"), 7) == 2
    got = lattice_scores(documents(spark, sf_dir), ~held)
    return got.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_piece_lattice(spark, sf_dir):
    """Piece ids of all documents and whether they decode to the text."""
    return encode_documents(documents(spark, sf_dir))


@query
def op12_merkle_manifest(spark, sf_dir):
    """Merkle manifest of all documents by source, every row's proof, and
    whether it still holds once the line feeds of half the rows are gone."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    bare = F.when(id_remainder(F.col("doc_id"), 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claimed = record_digest([bare if c == "text" else F.col(c) for c in fields]).alias("claimed")
    m = merkle_manifest(documents(spark, sf_dir), fields, "source", "doc_id", keep=["doc_id", claimed])
    got = verified(proofs(m), m.root, F.col("row.claimed"))
    return got.select("row.doc_id", as_text(F.col("h")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"), F.lit(m.root).alias("root"),
                      as_text(proof_digest(F.col("path"))).alias("proof_sha256"), "folded_root", "verified")


@query
def op13_graph_neighbours(spark, sf_dir):
    """The 20 nearest vectors of every row whose id is divisible by 20."""
    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


@query
def op11_token_alignment(spark, sf_dir):
    """Tokens of two tokenizers aligned in every document."""
    return token_alignment(documents(spark, sf_dir))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
