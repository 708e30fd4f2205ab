"""Tables bucketed by a join key, hot keys apart.

Two tables bucketed alike join and group by the key without a shuffle. A bucket
is read by one task, so a key that holds a large share of the rows must not be
in one: keys with more rows than an average bucket (there are fewer of them than
buckets) and rows without a key are written to a plain table beside the buckets,
and join on their own, where Spark may split them.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Colocated:
    """``cold`` is the bucketed table's rows, ``rest`` those of the hot keys and
    of no key."""

    table: str
    path: str
    key: str
    buckets: int
    hot: tuple
    schema: T.StructType

    def cold(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def rest(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(os.path.join(self.path, "rest"))

    def rows(self, spark: SparkSession) -> DataFrame:
        return self.cold(spark).unionByName(self.rest(spark))


def hot_keys(df: DataFrame, key: str, buckets: int) -> tuple:
    """Keys with more rows than ``rows / buckets``: fewer than ``buckets``."""
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bound = df.count() / buckets
    return tuple(sorted(r[0] for r in per.where(F.col("n") > bound).select(key).collect()))


def write_colocated(df: DataFrame, table: str, path: str, key: str, buckets: int, like: Colocated | None = None) -> Colocated:
    """Write ``df`` under ``path``, registered as ``table``. ``like`` is a table
    to join with: its buckets and hot keys are taken over. Choose as many
    buckets as the larger table needs tasks."""
    buckets = like.buckets if like else buckets
    hot = like.hot if like else hot_keys(df, key, buckets)
    apart = F.col(key).isNull()
    if hot:
        apart = apart | F.col(key).isin(list(hot))
    cold = df.where(~apart).repartition(buckets, key)
    (cold.write.mode("overwrite").option("path", os.path.join(path, "cold")).bucketBy(buckets, key).sortBy(key).format("parquet")
     .saveAsTable(table))
    df.where(apart).write.mode("overwrite").parquet(os.path.join(path, "rest"))
    return Colocated(table, path, key, buckets, hot, df.schema)


def join_colocated(spark: SparkSession, left: Colocated, right: Colocated, how: str = "inner") -> DataFrame:
    """``left`` with ``right`` (written ``like`` it) on the key, inner or left:
    bucket by bucket, the hot keys by a join of their own."""
    if (left.key, left.buckets, left.hot) != (right.key, right.buckets, right.hot):
        raise ValueError("the tables are not bucketed alike")
    if how not in ("inner", "left"):
        raise ValueError(f"inner or left, not {how}")
    return (left.cold(spark).join(right.cold(spark), left.key, how)
            .unionByName(left.rest(spark).join(right.rest(spark), left.key, how)))


def join_group(spark: SparkSession, rows: Colocated, aggregate) -> DataFrame:
    """Rows with what ``aggregate`` (frame → one row a key) makes of their key,
    left join. The hot keys' side has fewer rows than buckets, so it is
    broadcast; rows without a key get nulls."""
    cold, rest = rows.cold(spark), rows.rest(spark)
    hot = aggregate(rest.where(F.col(rows.key).isNotNull()))
    return (cold.join(aggregate(cold), rows.key, "left")
            .unionByName(rest.join(F.broadcast(hot), rows.key, "left")))
