"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once a context).

    The archive is code, handed out by Spark itself; no data takes this way.
    """
    sc = spark.sparkContext
    if getattr(sc, "_denialscope_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="denialscope-code-"), "denialscope_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    sc._denialscope_shipped = True


#: Rows that go to a Python worker at a time, for whole documents; Spark's
#: default of 10,000 takes several times the memory.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Unless the launcher has chosen a batch size, use ``BATCH_ROWS``."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def release() -> None:
    """Give what a finished task has freed back to the machine: a Python
    worker waits for its next task with the memory of its largest one."""
    import ctypes
    import gc

    import pyarrow
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run):
    """``run`` (a function of batches, for mapInArrow), then ``release``."""
    def wrapped(batches):
        yield from run(batches)
        release()
    return wrapped


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes inside, unless told to keep them, are
    deleted at the end: for steps whose result is written by then. A failed
    step leaves none behind either."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back:
    cuts the lineage, survives lost executors, and lets later steps prune
    columns. Inside ``scratch`` the table goes at its end, but with ``keep``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    paths = _scratch.get()
    if paths is not None and not keep:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
