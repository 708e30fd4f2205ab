"""Tables whose readers see a publication whole or not at all.

A table is a folder of publications (``data/pub=<id>/<key>=<value>``) and a log.
``publish`` writes its rows aside under a fresh id, then adds one log file that
says which key values the publication now stands for. That file is the commit:
it is a single file, which stores make visible in one step, and readers open
only what the log names. A writer that fails before it leaves files that nobody
reads; a re-run replaces the keys of the run before. Replaced publications stay
until the store's own clean-up, so that running readers can finish.

The log also holds each publication's schema. Readers get the merged schema of
the live ones without opening a data file: columns added later are null in older
rows, numbers that became wider are read as the wider type.

One writer a table at a time: of two that commit the same version the second
fails and can run again.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files

LOG_SCHEMA = "key STRING, pub STRING, fields STRING, v LONG"
#: Every so many versions the log file holds the whole state, so that readers
#: open at most that many.
SNAPSHOT_EVERY = 64
#: From which types Parquet scans read a wider one.
WIDER = {"tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"), "int": ("bigint", "double"),
         "float": ("double",)}


def _data(path: str) -> str:
    return os.path.join(path, "data")


def _latest(spark: SparkSession, path: str) -> int:
    """The last version of the log, 0 if there is none; lists names only."""
    log = os.path.join(path, "log")
    if not files.exists(spark, log):
        return 0
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(log).select("path")
    found = names.agg(F.max(F.regexp_extract("path", r"/v=(\d+)/", 1).cast("long"))).first()[0]
    return found or 0


def _state(spark: SparkSession, path: str, version: int) -> list:
    """The live rows of the log at ``version``: one a key value."""
    if version == 0:
        return []
    since = version - version % SNAPSHOT_EVERY
    log = spark.read.schema(LOG_SCHEMA).json(os.path.join(path, "log")).where(F.col("v").between(since, version))
    last = F.max_by(F.struct("pub", "fields", "v"), "v").alias("last")
    return log.groupBy("key").agg(last).select("key", "last.*").collect()


def _text(k) -> str | None:
    return None if k is None or k == "" else str(k)


def merge_fields(schemas: list[str]) -> T.StructType:
    """One schema of several (JSON, oldest first): columns by name in order of
    first appearance, each of the widest type it has had. A column whose types
    have no common one is an error that names it."""
    types: dict[str, T.DataType] = {}
    for text in schemas:
        for f in T.StructType.fromJson(json.loads(text)).fields:
            old = types.get(f.name, f.dataType)
            a, b = old.simpleString(), f.dataType.simpleString()
            if a == b or a in WIDER.get(b, ()):
                types[f.name] = old
            elif b in WIDER.get(a, ()):
                types[f.name] = f.dataType
            else:
                raise ValueError(f"column {f.name} was {a} and is now {b}")
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def publish(df: DataFrame, path: str, key: str, keys: list | None = None) -> int:
    """Replace the rows of key values by those of ``df``; the new version.

    ``keys`` are the values replaced (default: those in ``df``); one of them
    without rows is empty from then on. Key values are kept as text, null is a
    value of its own (as is empty text, which Spark stores as null); there should be as many of them as a table has partitions
    (days, batches). An empty frame without ``keys`` changes nothing but adds
    its columns to no version."""
    spark = df.sparkSession
    pub = uuid.uuid4().hex
    target = os.path.join(_data(path), f"pub={pub}")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name != key])
    version = _latest(spark, path)
    live = _state(spark, path, version)
    merge_fields([r.fields for r in sorted(live, key=lambda r: (r.v, r.key or ""))] + [schema.json()])  # a clash shows before the write
    df.withColumn(key, F.col(key).cast("string")).write.mode("error").partitionBy(key).parquet(target)
    if keys is None:
        written = spark.read.schema(T.StructType([*schema.fields, T.StructField(key, T.StringType())])).parquet(target)
        keys = [r[0] for r in written.select(key).distinct().collect()]
    new = [(_text(k), pub, schema.json(), version + 1) for k in keys]
    if not new:
        return version
    rows = new
    if (version + 1) % SNAPSHOT_EVERY == 0:
        replaced = {r[0] for r in new}
        rows = new + [(r.key, r.pub, r.fields, r.v) for r in live if r.key not in replaced]
    log = spark.createDataFrame([(k, p, f) for k, p, f, _ in rows], "key STRING, pub STRING, fields STRING")
    log.coalesce(1).write.mode("error").json(os.path.join(path, "log", f"v={version + 1}"))
    return version + 1


def _is_live(key: str, live: list) -> Column:
    """Whether a row's publication stands for its key value; a filter on
    partition columns only, which Spark applies to the list of folders."""
    tag = F.concat("pub", F.coalesce(F.concat(F.lit("v"), F.col(key)), F.lit("n")))
    return tag.isin([r.pub + ("n" if r.key is None else "v" + r.key) for r in live])


def read_published(spark: SparkSession, path: str, key: str, keys: list | None = None, version: int | None = None,
                   empty: T.StructType | None = None) -> DataFrame:
    """The table as of ``version`` (default: the last), of ``keys`` only if
    given. ``empty`` is the schema of a table that nothing has been published
    to. The key is a string column, the last one."""
    last = _latest(spark, path)
    live = _state(spark, path, last if version is None else min(version, last))
    if not live:
        if empty is None:
            raise ValueError(f"nothing has been published to {path}")
        return spark.createDataFrame([], empty)
    merged = merge_fields([r.fields for r in sorted(live, key=lambda r: (r.v, r.key or ""))])
    if keys is not None:
        wanted = {_text(k) for k in keys}
        live = [r for r in live if r.key in wanted]
    schema = T.StructType([*merged.fields, T.StructField("pub", T.StringType()), T.StructField(key, T.StringType())])
    if not live:
        return spark.createDataFrame([], schema).drop("pub")
    base = _data(path)
    folders = sorted({os.path.join(base, f"pub={r.pub}") for r in live})
    rows = spark.read.schema(schema).option("basePath", base).parquet(*folders)
    return rows.where(_is_live(key, live)).drop("pub")


def compact(spark: SparkSession, path: str, key: str, keys: list | None = None, rows_per_file: int = 1_000_000) -> int:
    """Publish key values anew from few files instead of many small ones, all
    in one commit. Rows go to files by key and a random number, so that a large
    key is spread over as many tasks as its rows need."""
    whole = read_published(spark, path, key, keys)
    live = [r.key for r in _state(spark, path, _latest(spark, path))]
    if keys is not None:
        wanted = {_text(k) for k in keys}
        live = [k for k in live if k in wanted]
    parts = max(1, -(-whole.count() // rows_per_file))
    return publish(whole.repartitionByRange(parts, F.col(key), F.rand(7)), path, key, live)


def live_files(spark: SparkSession, path: str, key: str) -> int:
    """How many data files the readers of the last version open."""
    return read_published(spark, path, key).select(F.col("_metadata.file_path").alias("p")).distinct().count()
