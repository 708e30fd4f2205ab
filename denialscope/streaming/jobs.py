"""Structured Streaming jobs: claim scoring (X1) with per-batch summaries
(X2), daily predicted-denial-rate monitor (X3), de-duplicating ingest (X4).

Sources are file streams of claims (Parquet, explicit schema); sinks are
Parquet with checkpoints, so a restarted query resumes exactly where it
stopped. ``foreachBatch`` writers overwrite a ``batch_id`` partition, which
makes a replayed micro-batch idempotent. State is kept on the executors' disks (RocksDB with
changelog checkpoints) unless the launcher has chosen a state store.
"""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import feature_exprs
from ..functions.rules import exact_avg
from ..operators import drift as DR
from ..operators import history as H
from ..operators import scoring as SC
from ..operators import validate as VA
from ..sources.published import publish, read_published
from ..sources.schema import CLAIMS_SCHEMA

EVENT_TS = "event_ts"


RANGE = "stage_range"


def stage_ranges(claims: DataFrame, path: str, bounds: list[str], date_col: str = "service_date") -> list[int]:
    """Write claims once, in one folder a date range: before the first bound,
    between bounds, from the last one, and without a date. Returns the ranges
    that have rows, in the order of time."""
    d = F.col(date_col)
    at = F.lit(len(bounds) + 1)
    for k, bound in reversed(list(enumerate([*bounds, None]))):
        at = F.when(d < F.lit(bound).cast("date"), k).otherwise(at) if bound else F.when(d.isNotNull(), k).otherwise(at)
    claims.withColumn(RANGE, at).write.partitionBy(RANGE).parquet(path)
    return sorted(r[0] for r in claims.sparkSession.read.parquet(path).select(RANGE).distinct().collect())


def arrive(spark: SparkSession, staged: str, k: int, source: str) -> None:
    """Let the files of one staged range arrive at the stream's source."""
    spark.read.parquet(staged).where(F.col(RANGE) == k).drop(RANGE).write.mode("append").parquet(source)


#: Files that a micro-batch takes at most, unless the caller says otherwise.
MAX_FILES = 1_000


def claim_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """File stream of claims; a micro-batch takes at most ``max_files``."""
    return spark.readStream.schema(CLAIMS_SCHEMA).option("maxFilesPerTrigger", max_files or MAX_FILES).parquet(path)


DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def disk_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, whose size is that
    of the disk and not of the heap; a launcher's own choice of store stays."""
    provider = next(iter(DISK_STATE))
    chosen = spark.sparkContext.getConf().contains(provider)
    old = {k: spark.conf.get(k, None) for k in DISK_STATE}
    if not chosen:
        for k, v in DISK_STATE.items():
            spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _with_event_time(df: DataFrame, date_col: str = "service_date") -> DataFrame:
    return df.withColumn(EVENT_TS, F.col(date_col).cast("timestamp"))


def _run(query, timeout: float | None = None):
    query.awaitTermination(timeout)
    if query.exception() is not None:
        raise query.exception()
    return query


# ----------------------------------------------------------------- X1 + X2
def score_microbatch(batch: DataFrame, batch_id: int, rates: DataFrame, out: str, scorer=None) -> None:
    """Validate → serve-policy features (provider rate from the static
    history rates) → score → write; invalid rows → quarantine; A15 summary,
    counted from the predictions as published."""
    valid, quarantine = VA.split_claims(batch)
    # Provider rates grow with the provider count: no broadcast hint, the
    # planner broadcasts them only when they are actually small.
    joined = valid.join(rates, on=H.NPI, how="left")
    rate = F.least(F.greatest(F.coalesce(F.col("history_rate"), F.lit(0.25)), F.lit(0.0)), F.lit(1.0))
    exprs = feature_exprs("serve", provider_rate=rate)
    raw = [c for c in joined.columns if c not in exprs and c != "history_rate"]
    feats = joined.select(*raw, *[e.alias(n) for n, e in exprs.items()])

    def put(name: str, rows: DataFrame) -> None:
        publish(rows.withColumn("batch_id", F.lit(batch_id).cast("long")), os.path.join(out, name), "batch_id", [batch_id])
    put("predictions", SC.predict_claims(feats, scorer))
    put("quarantine", quarantine)
    put("batch_summary", SC.batch_summary(read_batches(batch.sparkSession, out, "predictions", [batch_id])))


def read_batches(spark: SparkSession, out: str, name: str, batches: list[int] | None = None) -> DataFrame:
    """``predictions``, ``quarantine`` or ``batch_summary`` of the batches
    published so far (or of ``batches`` only); a batch is there whole or not at all."""
    rows = read_published(spark, os.path.join(out, name), "batch_id", batches)
    return rows.withColumn("batch_id", F.col("batch_id").cast("long"))


def stream_score(spark: SparkSession, source: str, out: str, history: DataFrame,
                 checkpoint: str, max_files: int | None = None, scorer=None, models_dir: str | None = None):
    """Score a claim stream until the available files are consumed,
    with the given scorer, else the model promoted under ``models_dir``, else
    the rules."""
    scorer = scorer or SC.promoted_scorer(spark, models_dir)
    rates = H.history_rates(history).cache()  # static side, reused by every micro-batch
    try:
        rates.count()  # from here on the planner knows its size
        q = (claim_stream(spark, source, max_files).writeStream
             .foreachBatch(lambda df, bid: score_microbatch(df, bid, rates, out, scorer))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        _run(q)
    finally:
        rates.unpersist()
    return read_batches(spark, out, "predictions")


# --------------------------------------------------------------------- X3
def stream_denial_rate(spark: SparkSession, source: str, out: str, checkpoint: str,
                       delay: str = "1 day", max_files: int | None = None, output_mode: str = "append"):
    """Daily tumbling windows of predicted denial rate and mean p with
    the K4 status; rows without a date belong to no window, and late rows
    beyond the watermark are dropped; append mode emits a window once the
    watermark passes its end."""
    s = _with_event_time(claim_stream(spark, source, max_files))
    exprs = feature_exprs("serve")
    feats = s.select(*[c for c in s.columns if c not in exprs], *[e.alias(n) for n, e in exprs.items()])
    scored = SC.RuleScorer().score(feats)
    p = F.col(SC.P)
    agg = (scored.withWatermark(EVENT_TS, delay).groupBy(F.window(EVENT_TS, "1 day"))
           .agg(F.count(F.lit(1)).alias("n_claims"), F.avg((p >= 0.5).cast("double")).alias("predicted_denial_rate"),
                exact_avg(p).alias("mean_probability")))
    z = F.abs(F.col("mean_probability") - DR.HISTORICAL_MEAN) / DR.HISTORICAL_STD
    res = agg.select(F.to_date(F.col("window.start")).alias("window_date"),
                     "n_claims", "predicted_denial_rate", "mean_probability",
                     F.when(z > 3, "critical").when(z > 2, "warning").otherwise("stable").alias("status"))
    with disk_state(spark):
        q = (res.writeStream.outputMode(output_mode).format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        _run(q)
    return spark.read.parquet(out)


# --------------------------------------------------------------------- X4
def stream_ingest(spark: SparkSession, source: str, out: str, checkpoint: str,
                  delay: str = "30 days", max_files: int | None = None):
    """Incremental ingest with de-duplication by claim_id within the
    watermark; the checkpoint remembers which files were already read."""
    s = _with_event_time(claim_stream(spark, source, max_files))
    dedup = s.withWatermark(EVENT_TS, delay).dropDuplicatesWithinWatermark(["claim_id"])
    with disk_state(spark):
        q = (dedup.drop(EVENT_TS).writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        _run(q)
    return spark.read.schema(CLAIMS_SCHEMA).parquet(out)


#: Buckets of the key table: a batch is compared bucket by bucket.
KEY_BUCKETS = 64


def _bucket(claim_id):
    return F.pmod(F.xxhash64(claim_id), F.lit(KEY_BUCKETS)).cast("int").alias("bucket")


def fresh_claims(batch: DataFrame, known: DataFrame | None) -> DataFrame:
    """One claim of each id that ``known`` has not. Known ids go first and by the
    id alone, so that their join and what is left of repeats share one shuffle
    and one sort of the claims."""
    named = batch.where("claim_id is not null")
    if known is not None:
        named = named.join(known, "claim_id", "left_anti")
    return named.dropDuplicates(["claim_id"]).select(*batch.columns)


def ingest_microbatch(batch: DataFrame, batch_id: int, out: str) -> None:
    """Keep the claims of a batch whose id no batch before has brought. Ids go
    to the key table (by batch and bucket, with Parquet bloom filters, so that
    row groups without any of a few ids are passed over). A replayed batch sees
    the keys of those before it only, and replaces what it wrote. Claims
    without an id are all kept."""
    spark = batch.sparkSession
    keys, claims = os.path.join(out, "keys"), os.path.join(out, "claims")
    known = None
    if batch_id > 0:
        known = (spark.read.schema("claim_id STRING, batch_id BIGINT, bucket INT").option("basePath", keys).parquet(keys)
                 .where(F.col("batch_id") < batch_id).select("claim_id"))
    where = os.path.join(claims, f"batch_id={batch_id}")
    fresh_claims(batch, known).unionByName(batch.where("claim_id is null")).write.mode("overwrite").parquet(where)
    ids = spark.read.schema(CLAIMS_SCHEMA).parquet(where).where("claim_id is not null").select("claim_id", _bucket(F.col("claim_id")))
    (ids.repartition("bucket").write.mode("overwrite").option("parquet.bloom.filter.enabled#claim_id", "true").partitionBy("bucket")
     .parquet(os.path.join(keys, f"batch_id={batch_id}")))


def stream_ingest_exact(spark: SparkSession, source: str, out: str, checkpoint: str, max_files: int | None = None):
    """X4 without a horizon: a claim sent again is left out however late it
    comes. What is known is a stored key table and no stream state."""
    q = (claim_stream(spark, source, max_files).writeStream.foreachBatch(lambda df, bid: ingest_microbatch(df, bid, out))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _run(q)
    return spark.read.schema(CLAIMS_SCHEMA).option("basePath", os.path.join(out, "claims")).parquet(os.path.join(out, "claims"))
