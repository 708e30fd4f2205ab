"""Registered queries: dashboard tables (Q3), claim detail (Q4), monitoring
run (K5), drift report sink (S14)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import drift as DR
from ..session import scratch_path
from ..sources import files
from ..sources.fixtures import claims
from ..sources.schema import FEATURE_COLUMNS
from . import sqlparts as S
from .dashboard import claim_detail, overview_tables
from .daily import daily_scoring
from .q_eval import _LV, _PSI_CTES, _REPORT_SQL, RUN_TS
from .q_io import RUN_DATE, SINCE
from .registry import ORACLE, register

# --------------------------------------------------------------------- Q3
_OVERVIEW = {  # table → (registered sub-query, key columns, metric columns)
    "overview": ("kpi_overview", [], ["total_claims", "denial_rate", "avg_billed"]),
    "by_claim_type": ("kpi_by_claim_type", ["claim_type"], ["denial_rate", "n_claims"]),
    "monthly": ("kpi_monthly", ["service_month"], ["total", "denied", "approved"]),
    "billed_histogram": ("kpi_billed_histogram", ["bin", "is_denied"], ["bin_start", "bin_end", "n_claims"]),
    "billed_p95": ("kpi_billed_p95", [], ["billed_p95"]),
    "top_specialties": ("top_specialties", ["provider_specialty"], ["denial_rate", "n_claims"]),
    "pos_breakdown": ("kpi_pos_breakdown", ["pos_label"], ["n_claims"]),
}


def _key_sql(keys):
    return "''" if not keys else "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + ")"


def _overview_sql():
    parts = []
    for table, (name, keys, metrics) in _OVERVIEW.items():
        cols = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in metrics)
        inner = f"SELECT '{table}' AS tbl, {_key_sql(keys)} AS key, {cols} FROM ({ORACLE[name]}) AS sub"
        parts.append(f"SELECT tbl, key, metric, value FROM (UNPIVOT ({inner}) ON {', '.join(metrics)} "
                     f"INTO NAME metric VALUE value)")
    return "\nUNION ALL\n".join(parts)


def overview_long(tables: dict):
    out = None
    for table, (_, keys, metrics) in _OVERVIEW.items():
        df = tables[table]
        key = F.lit("") if not keys else F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        long = (df.select(F.lit(table).alias("tbl"), key.alias("key"),
                          *[F.col(m).cast("double").alias(m) for m in metrics])
                .unpivot(["tbl", "key"], metrics, "metric", "value"))
        out = long if out is None else out.unionByName(long)
    return out


@register("overview_tables", _overview_sql())
def q_overview_tables(spark, d):
    """Q3: every overview table from one written copy, in long form."""
    return overview_long(overview_tables(claims(spark, d)))


# --------------------------------------------------------------------- Q4
_TARGET = "(SELECT min(claim_id) FROM claims WHERE claim_type = 'dental')"
_ONE = f"one AS (SELECT * FROM claims WHERE claim_id = {_TARGET})"
_REIMB_SERVE = S.np_round_sql("CASE WHEN p_denial >= 0.5 THEN 0.0 WHEN allowed_amount > 0 THEN allowed_amount "
                              "ELSE billed_amount * 0.65 END", 2)


@register("claim_detail", S.with_(policy="serve", scored=True, src="one", rate="hist", pre=(_ONE,)) + f"""SELECT
  claim_id, {S.np_round_sql("p_denial", 4)} AS denial_probability, p_denial >= 0.5 AS predicted_denied,
  array_to_string({S.REASONS}, '|') AS denial_reasons, {_REIMB_SERVE} AS estimated_reimbursement,
  {S.CONF_SERVE} AS confidence, '1.2.0' AS model_version FROM sc""")
def q_claim_detail(spark, d):
    """Q4: serve-form record of one looked-up claim (id found in the data)."""
    c = claims(spark, d)
    target = c.where("claim_type = 'dental'").agg(F.min("claim_id")).first()[0]
    return claim_detail(c, target, parts=("prediction",))["prediction"]


# --------------------------------------------------------------------- K5
_BT = f"bt AS (SELECT * FROM claims WHERE submission_date > DATE '{SINCE}')"


def _second_features():
    arr2 = S.arr_cte("bt", "roll").replace("arr AS (", "arr2 AS (", 1)
    feat2 = S.feat_cte("feat2", "batch").replace("FROM arr\n)", "FROM arr2\n)")
    return [arr2, feat2]


_K5_MI2 = ("mi2 AS (SELECT 'train' AS dataset, " + ", ".join(
    f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS) + " FROM feat UNION ALL SELECT 'score', "
    + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS) + " FROM feat2)")
_K5_SQL = _REPORT_SQL.replace(f"'{RUN_TS}' AS timestamp", f"'{RUN_DATE}T02:00:00' AS timestamp")
_K5_SQL = _K5_SQL.replace(S.base_ctes(), S.base_ctes(pre=(_BT,), rate="roll") + ",\n" + ",\n".join(_second_features()), 1)
_K5_SQL = _K5_SQL.replace(_PSI_CTES[0], _K5_MI2, 1)
assert _LV in _K5_SQL


@register("monitoring_run", _K5_SQL)
def q_monitoring(spark, d):
    """K5: drift report of the daily batch against the training claims."""
    out = daily_scoring(claims(spark, d), RUN_DATE, SINCE, scratch_path(spark, f"monitoring/{uuid.uuid4().hex}"))
    return out["drift_report"]


@register("sink_drift_report", _REPORT_SQL)
def q_sink_report(spark, d):
    """Drift report written as JSON and read back."""
    from .q_eval import _split_mi
    tr, sc = _split_mi(spark, d)
    rep = DR.drift_report(DR.drift_features(tr, sc), run_ts=RUN_TS)
    path = scratch_path(spark, f"reports/{uuid.uuid4().hex}")
    files.write_json(rep, path)
    back = spark.read.schema(rep.schema).json(path)
    return back


