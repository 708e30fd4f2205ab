"""From raw documents to piece ids: rules, language, duplicates, benchmark
leaks, encoding.

Each stage is (name, function of (spark, docs, sf_dir)) and works on all that
the stage before kept. ``run`` writes every stage's result to the shared folder
and reads it back as the next one's input, so a lost executor costs at most the
running stage. All but the last stage return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from denialscope.llm.common import documents, id_remainder, scratch, small_batches, written
from denialscope.llm.decontaminate import decontaminate
from denialscope.llm.language_id import accepted, predict_language, train_language_id
from denialscope.llm.piece_lattice import encode_documents
from denialscope.llm.simhash import RADIUS, SHINGLE, simhash_components
from denialscope.llm.weak_quality import weak_quality

#: Least score of a recognised language; about what an even split of four gives.
LEAST_LANGUAGE_SCORE = 0.3
#: Least likeness to the language's texts, whatever the number of languages. At
#: sf0.1 the held-out texts of learned languages have 0.57 or more, Finnish,
#: Polish, Russian, Greek, Chinese, hex digits and gibberish 0.43 or less.
LEAST_LANGUAGE_LIKENESS = 0.5


def columns(df: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in df.columns]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or what no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    out = fresh(docs, "_quality")
    return weak_quality(docs, out=out).where(F.col(f"{out}.kept")).select(*columns(docs))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; learned from the rows whose
    crc32(doc_id) mod 4 is not 2 and whose ``lang`` is known."""
    small_batches(spark)
    model = train_language_id(docs.where(id_remainder(F.col("doc_id"), 4) != 2))
    if model is None:  # nothing to recognise a language by
        return docs
    lang, score, like = (fresh(docs, c) for c in ("__lang", "__score", "__like"))
    got = predict_language(docs, model, lang_out=lang, score_out=score, like_out=like)
    known = accepted(F.col(lang), F.col(score), LEAST_LANGUAGE_SCORE) & (F.col(like) >= LEAST_LANGUAGE_LIKENESS)
    return got.where(known).select(*columns(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: the smallest id, and of repeated
    rows the first."""
    small_batches(spark)
    row = fresh(docs, "__row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "dedup-rows")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    classes = simhash_components(rows.select(key.alias("key"), "text"), "key", "text", SHINGLE, RADIUS)
    stay = classes.where(F.col("key") == F.col("component_id")).select(F.col("key.row").alias(row))
    return rows.join(stay, row, "left_semi").select(*columns(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    small_batches(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece ids, their number, and whether they decode to the text."""
    small_batches(spark)
    return encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("piece_encoding", piece_encoding),
]

#: SQL can express neither the classifier nor the alignment nor the fold.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        with scratch(spark):  # what the stage writes for itself goes with it
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
