"""Bounded, deterministic samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounded_sample(df: DataFrame, id_col: str, class_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows in all, as many of each class where it has them,
    chosen by a hash of the id. Rows of one class and id count once.

    The class counts reach the driver (classes are assumed to be few); only
    about twice the sample is ranked.
    """
    counts = {r[0]: r[1] for r in df.groupBy(class_col).count().collect() if r[0] is not None}
    if not counts:
        return df.limit(0)
    each = max(1, rows // len(counts))
    spread = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    rate = F.lit(0.0)
    for value, n in counts.items():
        rate = F.when(F.col(class_col) == value, min(1.0, 2.0 * each / n)).otherwise(rate)
    picked = df.withColumn("_spread", spread).where(F.col("_spread") < rate).dropDuplicates([class_col, "_spread"])
    rank = F.row_number().over(Window.partitionBy(class_col).orderBy("_spread"))
    return picked.withColumn("_rank", rank).where(F.col("_rank") <= each).drop("_spread", "_rank")
