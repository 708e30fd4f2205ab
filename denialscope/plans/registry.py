"""Registry of named queries (Spark) and their DuckDB oracles.

``register(name, sql)`` records a callable ``(spark, sf_dir) -> DataFrame``
and, when given, the oracle SQL. Both engines' results get the same
comparable shape: doubles rounded NumPy-style (``rint(x·10⁶)/10⁶``, an
exact, deterministic operation on identical doubles), arrays joined with
``|``, dates as ISO text, maps as key-sorted JSON. ``oracle_export.py`` beside
the package gives the oracles that shape.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
EXPORT_DECIMALS = 6
_SCALE = float(10 ** EXPORT_DECIMALS)


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return export(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _round(c):
    return F.rint(c * _SCALE) / _SCALE


def export(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = _round(c.cast("double"))
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, T.MapType):
            c = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c))))
        cols.append(c.alias(f.name))
    return df.select(*cols)
