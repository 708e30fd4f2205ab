"""The registered oracles in the shape that queries are exported in.

Part of the comparison with DuckDB, not of the library: every DOUBLE column of
an oracle is rounded as ``denialscope.plans.registry.export`` rounds Spark's.
"""

from __future__ import annotations

import glob
import os

import duckdb

from denialscope.plans.catalog import ORACLE
from denialscope.plans.registry import EXPORT_DECIMALS
from denialscope.sources.fixtures import TABLES

_SCALE = float(10 ** EXPORT_DECIMALS)


def _describe_conn(sf_dir: str | None = None):
    """DuckDB connection with the driver's table names as views (schema only
    is needed: the oracles are bound, not run, to learn their column types)."""
    candidates = [sf_dir] if sf_dir else sorted(glob.glob("/root/testdata/sf*"))
    con = duckdb.connect()
    for d in candidates:
        if d and all(os.path.exists(os.path.join(d, f"{t}.parquet")) for t in ("lineitem", "orders")):
            for t in TABLES:
                p = os.path.join(d, f"{t}.parquet")
                if os.path.exists(p):
                    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
            return con
    return None


def _qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def wrap_oracle(sql: str, con) -> str:
    """Apply the export conventions to an oracle: DOUBLE/DECIMAL columns
    rounded like ``export``; other columns passed through."""
    if con is None:
        return sql
    body = sql.strip().rstrip(";")
    cols = con.execute(f"DESCRIBE {body}").fetchall()
    scale = f"CAST({_SCALE!r} AS DOUBLE)"
    sel = []
    for name, typ, *_ in cols:
        if typ in ("DOUBLE", "FLOAT", "REAL") or typ.startswith("DECIMAL"):
            sel.append(f"(round_even(CAST(_q.{_qi(name)} AS DOUBLE) * {scale}, 0) / {scale}) AS {_qi(name)}")
        else:
            sel.append(f"_q.{_qi(name)}")
    return f"SELECT {', '.join(sel)} FROM (\n{body}\n) AS _q"


_WRAPPED: dict[str, str] = {}


def oracle_sql() -> dict[str, str]:
    if not _WRAPPED:
        con = _describe_conn()
        for k, v in ORACLE.items():
            _WRAPPED[k] = wrap_oracle(v, con)
    return dict(_WRAPPED)
