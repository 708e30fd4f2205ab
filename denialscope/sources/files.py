"""File sources and sinks: claims CSV / Parquet, feature tables, prediction
history, JSON reports.

Paths are expected on shared storage (HDFS/S3/ABFS) on a cluster; every
writer is an overwrite of a well-defined target (or of one partition), so
re-running a job after a failure is idempotent.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_dropped
from .schema import CLAIM_COLUMNS, CLAIMS_CSV_SCHEMA, CLAIMS_SCHEMA, REQUEST_SCHEMA

NULL_TOKEN = "\\N"


def write_claims_csv(claims: DataFrame, path: str) -> None:
    """S2 (CSV): headered CSV with an explicit null token so that empty
    strings and nulls survive a round trip; whitespace is kept verbatim."""
    (claims.select(*CLAIM_COLUMNS).write.mode("overwrite")
     .option("header", True).option("nullValue", NULL_TOKEN)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("dateFormat", "yyyy-MM-dd").csv(path))


def read_claims_csv(spark: SparkSession, path: str, null_token: str | None = NULL_TOKEN) -> DataFrame:
    """Strict-schema CSV scan (never infers: codes stay strings).

    PERMISSIVE mode keeps malformed lines in ``_corrupt_record``; dates are
    parsed with ``try_to_date`` so a bad date becomes null plus a
    ``date_error`` flag instead of failing the job. Files without a null
    token (``null_token=None``) treat empty fields as null, like the
    reference's own files.
    """
    reader = (spark.read.schema(CLAIMS_CSV_SCHEMA).option("header", True)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
              .option("columnPruning", False))  # a line that breaks off is seen whatever columns are asked for
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    raw = reader.csv(path)
    svc, sub = F.col("service_date"), F.col("submission_date")
    parsed_svc = F.try_to_date(svc, "yyyy-MM-dd")
    parsed_sub = F.try_to_date(sub, "yyyy-MM-dd")
    bad_date = ((svc.isNotNull() & parsed_svc.isNull()) | (sub.isNotNull() & parsed_sub.isNull()))
    # the flag looks at the text, so it comes before the dates replace it
    out = raw.withColumn("date_error", bad_date).withColumn("service_date", parsed_svc).withColumn("submission_date", parsed_sub)
    return out.select(*CLAIM_COLUMNS, "_corrupt_record", "date_error")


def read_requests_json(spark: SparkSession, path: str) -> DataFrame:
    """Request-form claims (code arrays, no label) as JSON lines; an absent
    code list is empty."""
    raw = spark.read.schema(REQUEST_SCHEMA).json(path)
    for c in ("diagnosis_codes", "procedure_codes"):
        raw = raw.withColumn(c, F.coalesce(F.col(c), F.array().cast("array<string>")))
    return raw


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_claims_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLAIMS_SCHEMA).parquet(path)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table to shared storage and return a scan of it — the
    lineage cut that lets later stages survive executor loss cheaply."""
    write_parquet(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def materialize_alone(df: DataFrame, path: str) -> DataFrame:
    """The same for large tables: the shuffle files that the table was made
    with are gone when it is written, so they do not add up on disk."""
    with shuffles_dropped(df.sparkSession):
        return materialize(df, path)


def append_partition(df: DataFrame, path: str, partition_col: str) -> None:
    """Dynamic partition overwrite — re-running a day replaces that
    day's partition instead of duplicating rows."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


PREDICTION_SCHEMA = T.StructType([
    T.StructField("claim_id", T.StringType()),
    T.StructField("denial_probability", T.DoubleType()),
    T.StructField("predicted_denied", T.BooleanType()),
    T.StructField("confidence", T.StringType()),
    T.StructField("estimated_reimbursement", T.DoubleType()),
    T.StructField("scored_date", T.StringType()),
])


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction history scan; an empty typed frame if nothing exists yet.
    Columns that only some partitions have are null in the others."""
    if not exists(spark, path):
        return spark.createDataFrame([], PREDICTION_SCHEMA)
    return spark.read.option("mergeSchema", True).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, asked through Spark's own
    file listing, so that any store and Spark Connect are served."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").isEmpty()
        return True
    except AnalysisException:
        return False


def write_json(df: DataFrame, path: str, compression: str | None = None) -> None:
    """JSON artifact, one file per partition; ``compression`` for
    large tables (a compressed file is read by one task)."""
    df.write.mode("overwrite").json(path, compression=compression)


def union_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """UNION ALL by column name, tolerating added columns."""
    return history.unionByName(new, allowMissingColumns=True)


def join_path(base: str, *parts: str) -> str:
    return os.path.join(base, *parts)
