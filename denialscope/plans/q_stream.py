"""Registered queries: Structured Streaming jobs (X1–X4) run to completion
over claim files staged (by Spark, from the given tables) in date order."""

from __future__ import annotations

import uuid

from ..session import scratch_path
from ..sources.fixtures import claims
from ..sources.schema import CLAIM_COLUMNS
from ..streaming import jobs as J
from . import sqlparts as S
from .q_core import _V_ALL, _dx_sql, _px_sql
from .q_io import _CLAIMS_SQL, _claims_out
from .registry import register

#: Service dates at which the staged claims are cut into arrivals.
BOUNDS = ["1996-01-01", "1998-01-01", "2000-01-01"]


def _stream(spark, d, run):
    """Stage the claims by date range, let one range after the other arrive,
    and run the stream after each: one micro-batch a range. ``run(claims,
    base, source)`` returns the result so far; the last is the whole."""
    base = scratch_path(spark, f"streams/{uuid.uuid4().hex}")
    c = claims(spark, d)
    for k in J.stage_ranges(c, f"{base}/staged", BOUNDS):
        J.arrive(spark, f"{base}/staged", k, f"{base}/source")
        out = run(c, base, f"{base}/source")
    return out, base


_KEEP = [c for c in CLAIM_COLUMNS if c not in ("claim_type", "place_of_service")]
_VA = f"va AS (SELECT *, {_dx_sql()} AS dx, {_px_sql()} AS px FROM claims)"
_VC = ("vc AS (SELECT " + ", ".join(_KEEP) + ", lower(claim_type) AS claim_type, "
       "coalesce(place_of_service, '11') AS place_of_service FROM va WHERE len(" + _V_ALL + ") = 0)")
_REIMB_SERVE = S.np_round_sql("CASE WHEN p_denial >= 0.5 THEN 0.0 WHEN allowed_amount > 0 THEN allowed_amount "
                              "ELSE billed_amount * 0.65 END", 2)
_X1_SQL = S.with_(policy="serve", scored=True, src="vc", rate="hist", pre=(_VA, _VC)) + f"""SELECT
  coalesce(claim_id, 'unknown') AS claim_id, {S.np_round_sql("p_denial", 4)} AS denial_probability,
  p_denial >= 0.5 AS predicted_denied, array_to_string({S.REASONS}, '|') AS denial_reasons,
  {_REIMB_SERVE} AS estimated_reimbursement, {S.CONF_SERVE} AS confidence, '1.2.0' AS model_version FROM sc"""


def _score(spark, d):
    # the labelled history is every claim, read from the staged copy
    return _stream(spark, d, lambda c, base, src: J.stream_score(
        spark, src, f"{base}/out", history=spark.read.parquet(f"{base}/staged"), checkpoint=f"{base}/ckpt"))


@register("stream_score", _X1_SQL)
def q_stream_score(spark, d):
    """Validate → serve features (history rates) → score, as a stream."""
    return _score(spark, d)[0].drop("batch_id")


_RANGE = "CASE " + " ".join(f"WHEN service_date < DATE '{x}' THEN {k}" for k, x in enumerate(BOUNDS)) + f" WHEN service_date IS NOT NULL THEN {len(BOUNDS)} ELSE {len(BOUNDS) + 1} END"
_X2_SQL = S.with_(policy="serve", scored=True, src="vc", rate="hist", pre=(_VA, _VC)) + f""",
tb AS (SELECT CAST(dense_rank() OVER (ORDER BY r) - 1 AS BIGINT) AS batch_id, r FROM (SELECT DISTINCT {_RANGE} AS r FROM claims)),
sb AS (SELECT {_RANGE} AS r, CAST(p_denial >= 0.5 AS INT) AS y FROM sc)
SELECT tb.batch_id, COUNT(sb.r) AS total_claims, CAST(coalesce(SUM(sb.y), 0) AS BIGINT) AS total_predicted_denied,
  coalesce(CAST(SUM(sb.y) AS DOUBLE) / NULLIF(COUNT(sb.r), 0), 0.0) AS batch_denial_rate
FROM tb LEFT JOIN sb ON tb.r = sb.r GROUP BY tb.batch_id"""


@register("stream_batch_summary", _X2_SQL)
def q_stream_summary(spark, d):
    """Per micro-batch totals, predicted denials and rate."""
    _, base = _score(spark, d)
    summary = J.read_batches(spark, f"{base}/out", "batch_summary")
    return summary.select("total_claims", "total_predicted_denied", "batch_denial_rate", summary.batch_id.cast("long").alias("batch_id"))


_MEAN = (f"CAST(SUM(CAST(round_even(p_denial * {S.D(1e9)}, 0) AS DECIMAL(38,0))) AS DOUBLE) "
         f"/ CAST(COUNT(p_denial) AS DOUBLE) / {S.D(1e9)}")
_Z = f"abs({_MEAN} - {S.D(0.25)}) / {S.D(0.05)}"
# Windows close when the final watermark (max event time − 1 day) passes
# their end: every day except the two newest.
_X3_SQL = S.with_(policy="serve", scored=True) + f"""SELECT CAST(service_date AS VARCHAR) AS window_date,
  COUNT(*) AS n_claims, AVG(CASE WHEN p_denial >= 0.5 THEN 1.0 ELSE 0.0 END) AS predicted_denial_rate,
  {_MEAN} AS mean_probability,
  CASE WHEN {_Z} > 3 THEN 'critical' WHEN {_Z} > 2 THEN 'warning' ELSE 'stable' END AS status
FROM sc WHERE service_date <= (SELECT max(service_date) FROM claims) - 2 GROUP BY service_date"""


@register("stream_denial_rate", _X3_SQL)
def q_stream_rate(spark, d):
    """Closed daily windows of predicted denial rate with K4 status."""
    return _stream(spark, d, lambda c, base, src: J.stream_denial_rate(spark, src, f"{base}/out", f"{base}/ckpt"))[0]


@register("stream_ingest", _CLAIMS_SQL)
def q_stream_ingest(spark, d):
    """De-duplicating incremental ingest of the claim files."""
    return _claims_out(_stream(spark, d, lambda c, base, src: J.stream_ingest(spark, src, f"{base}/out", f"{base}/ckpt"))[0])


@register("stream_ingest_exact", _CLAIMS_SQL)
def q_stream_ingest_exact(spark, d):
    """Claims sent again after every other range has come, far beyond any
    watermark, are taken once."""
    run = lambda c, base, src: J.stream_ingest_exact(spark, src, f"{base}/out", f"{base}/ckpt")
    _, base = _stream(spark, d, run)
    J.arrive(spark, f"{base}/staged", 0, f"{base}/source")
    return _claims_out(run(None, base, f"{base}/source"))
