"""Claim tables for point lookups.

Files are cut by ranges of the key and sorted by it, and carry Parquet bloom
filters on it. A lookup then opens the one or two files whose range holds the
id, and of these the row groups whose filter does not rule it out. Both checks
are the Parquet reader's own; a lookup is an ordinary pushed-down filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import CLAIMS_SCHEMA

ROWS_PER_FILE = 2_000_000
#: Bytes of a row group: small, as a lookup reads one of them.
ROW_GROUP = 16 << 20


def write_lookup(claims: DataFrame, path: str, key: str = "claim_id", rows_per_file: int = ROWS_PER_FILE,
                 row_group: int = ROW_GROUP) -> None:
    """Write ``claims`` for lookups by ``key``. Rows without a key come first;
    a key that many rows share spans several files."""
    parts = max(1, -(-claims.count() // rows_per_file))
    cut = claims.repartitionByRange(parts, F.col(key), F.rand(11)).sortWithinPartitions(key)
    (cut.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", str(rows_per_file)).option("parquet.block.size", str(row_group)).parquet(path))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The table; a filter on its key skips files and row groups."""
    return spark.read.schema(CLAIMS_SCHEMA).parquet(path)


def find(table: DataFrame, ids: list[str], key: str = "claim_id") -> DataFrame:
    """All rows of the given ids (a short list; longer ones are a table of
    their own and a join). Ids that no row has give none."""
    return table.where(F.col(key).isin(list(ids)))
