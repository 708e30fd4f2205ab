"""SparkSession construction and shared-folder helpers.

Cluster jobs get their session from the launcher; these helpers only fill in
settings that are unset, so tests and the bench can run on ``local[N]``.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
#: Local mode only: the driver JVM is the executor.
LOCAL_CONF = {"spark.driver.memory": "16g"}


def get_spark(master: str | None = None, app: str = "denialscope",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew-join splitting and UTC."""
    builder = SparkSession.builder.appName(app)
    running = SparkContext._active_spark_context
    given = running.getConf() if running else SparkConf()
    if master and not given.contains("spark.master"):
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if (given.get("spark.master", master) or "").startswith("local["):
        conf.update(LOCAL_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        if not given.contains(k):  # what the launcher has set stays
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: The longest method, in bytes of bytecode, that HotSpot compiles. A stage with a
#: longer one stays interpreted, at several times the CPU time a row.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
LONGEST_COMPILED = 8000


def compiled_methods(spark: SparkSession) -> SparkSession:
    """Let Spark run a stage operator by operator, in short methods, where its
    one generated method would be too long for HotSpot to compile. A limit that
    the launcher has chosen stays."""
    if not spark.sparkContext.getConf().contains(METHOD_LIMIT):
        spark.conf.set(METHOD_LIMIT, str(LONGEST_COMPILED))
    return spark


#: Spark deletes a query's shuffle files as soon as it has ended, and not when
#: the driver's JVM happens to collect the frame.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries that run inside leave no shuffle files behind; for writers whose
    result is read from then on."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the launcher (HDFS/S3/ABFS path). Only
    in local mode do we create a scratch folder when it is unset and register
    it, so lineage cuts still go through ``checkpoint()``.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="denialscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared folder for written intermediate tables."""
    return os.path.join(shared_dir(spark), name)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once a context).

    The archive is code, handed out by Spark itself; no data takes this way.
    """
    sc = spark.sparkContext
    if getattr(sc, "_denialscope_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="denialscope-code-"), "denialscope_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._denialscope_shipped = True
