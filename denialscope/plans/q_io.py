"""Registered queries: sources and sinks (S1, S2, S10–S14, S17, U1) and the
daily pipeline (Q1, K5). Writers target a fresh folder under the session's
shared checkpoint directory."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.features import dx_array, proc_array
from ..operators import features as FE
from ..operators import scoring as SC
from ..operators import validate as VA
from ..session import scratch_path
from ..sources import files, sampling
from ..sources import published as PB
from ..sources.fixtures import claims
from ..sources.schema import CLAIM_COLUMNS, FEATURE_COLUMNS
from . import sqlparts as S
from .q_core import _V_ALL, _dx_sql, _px_sql
from .daily import daily_scoring
from .registry import register

_C = "WITH " + S.claims_cte() + "\n"
_NULLABLE_INTS = ("days_supply", "member_age", "is_denied")
RUN_DATE = "2024-01-15"
SEED = int(RUN_DATE[-2:])
SAMPLE_SIZE = 2000  # S10: the size of the sample is its feature
SINCE = "2001-01-01"  # the run before, for the incremental ingest


def _scratch(spark, name):
    return scratch_path(spark, f"queries/{name}/{uuid.uuid4().hex}")


def _claims_out(df):
    return df.select(*[F.col(c).cast("double").alias(c) if c in _NULLABLE_INTS else F.col(c)
                       for c in CLAIM_COLUMNS])


_CLAIMS_SQL = _C + "SELECT " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in _NULLABLE_INTS else
    (f"CAST({c} AS VARCHAR) AS {c}" if c in ("service_date", "submission_date") else c)
    for c in CLAIM_COLUMNS) + " FROM claims"


@register("scan_claims_csv", _CLAIMS_SQL)
def q_scan_csv(spark, d):
    """Claims written as CSV then scanned with the strict schema."""
    path = _scratch(spark, "claims_csv")
    files.write_claims_csv(claims(spark, d), path)
    return _claims_out(files.read_claims_csv(spark, path))


@register("scan_claims_csv_errors", _C + """SELECT claim_id, claim_type = 'dental' AS date_error, _corrupt_record IS NOT NULL AS corrupt,
  CASE WHEN claim_type <> 'dental' THEN CAST(service_date AS VARCHAR) END AS service_date
FROM (SELECT *, NULL AS _corrupt_record FROM claims) UNION ALL SELECT claim_id, false, true, NULL FROM claims WHERE claim_type = 'pharmacy'""")
def q_scan_csv_errors(spark, d):
    """A CSV in which dental claims have a date that is none, and pharmacy
    claims a second line that breaks off after its id: both are flagged."""
    path = _scratch(spark, "claims_csv")
    c = claims(spark, d)
    bad = c.withColumn("service_date", F.when(F.col("claim_type") == "dental", "2024-13-45").otherwise(F.col("service_date").cast("string")))
    files.write_claims_csv(bad, path)
    c.where("claim_type = 'pharmacy'").select("claim_id").write.mode("append").option("header", True).csv(path)
    got = files.read_claims_csv(spark, path)
    return got.select("claim_id", "date_error", F.col("_corrupt_record").isNotNull().alias("corrupt"), "service_date")


@register("scan_requests_json", _C + f"""SELECT claim_id, CAST(len(dx) AS INT) AS n_diagnosis, CAST(len(px) AS INT) AS n_procedure, len({_V_ALL}) = 0 AS is_valid
FROM (SELECT * REPLACE (coalesce(diagnosis_codes, '') AS diagnosis_codes), {_dx_sql()} AS dx, {_px_sql()} AS px FROM claims)""")
def q_scan_requests(spark, d):
    """Request-form source: claims with code arrays written as JSON lines, read
    with the request schema, validated."""
    path = _scratch(spark, "requests_json")
    c = claims(spark, d).drop("is_denied")
    c = c.withColumn("diagnosis_codes", dx_array(F.col("diagnosis_codes"))).withColumn("procedure_codes", proc_array(F.col("procedure_codes")))
    files.write_json(c, path, "gzip")
    a = VA.annotate(files.read_requests_json(spark, path), F.col("diagnosis_codes"), F.col("procedure_codes"))
    return a.select("claim_id", F.size("diagnosis_codes").alias("n_diagnosis"), F.size("procedure_codes").alias("n_procedure"), "is_valid")


@register("sink_claims_roundtrip", _CLAIMS_SQL)
def q_sink_roundtrip(spark, d):
    """Claims written to Parquet and read back."""
    path = _scratch(spark, "claims_parquet")
    files.write_parquet(claims(spark, d), path)
    return _claims_out(files.read_claims_parquet(spark, path))


_SAMPLE_SQL = f"SELECT * FROM claims ORDER BY md5(claim_id || '|{SEED}'), claim_id LIMIT {SAMPLE_SIZE}"


@register("sample_daily_batch", _C + f"SELECT claim_id, claim_type, billed_amount FROM ({_SAMPLE_SQL})")
def q_sample(spark, d):
    """Exact-size seeded daily sample (2,000 claims)."""
    return sampling.daily_batch(claims(spark, d), SEED, SAMPLE_SIZE).select("claim_id", "claim_type", "billed_amount")


@register("ingest_since", _C + "SELECT claim_id, CAST(submission_date AS VARCHAR) AS submission_date FROM claims "
          f"WHERE submission_date > DATE '{SINCE}'")
def q_ingest_since(spark, d):
    """Claims submitted after the last run."""
    return sampling.ingest_since(claims(spark, d), SINCE).select("claim_id", "submission_date")


@register("materialize_features", S.with_(mi=True) + "SELECT claim_id, is_denied, " + ", ".join(FEATURE_COLUMNS)
          + " FROM mi")
def q_materialize(spark, d):
    """Model input + label written keyed by claim_id, read back."""
    mi = FE.model_input(FE.features_wide(claims(spark, d)), keep=("claim_id", "is_denied"))
    return files.materialize(mi, _scratch(spark, "features"))


_PRED_SQL = (S.with_(scored=True) + f"""SELECT claim_id, {S.np_round_sql("p_denial", 4)} AS denial_probability,
  p_denial >= 0.5 AS predicted_denied, {S.CONF_BATCH} AS confidence, {S.REIMB_BATCH} AS estimated_reimbursement,
  '{RUN_DATE}' AS scored_date FROM sc""")


def _preds(spark, d, date=RUN_DATE):
    return SC.predict_batch(FE.features_wide(claims(spark, d))).withColumn("scored_date", F.lit(date))


@register("prediction_history", _PRED_SQL)
def q_history(spark, d):
    """History partition written twice (a re-run) holds one copy."""
    path = _scratch(spark, "history")
    p = files.materialize(_preds(spark, d), _scratch(spark, "predictions"))  # scored once, written twice
    files.append_partition(p, path, "scored_date")
    files.append_partition(p, path, "scored_date")
    return files.read_predictions(spark, path)


@register("scan_predictions", _PRED_SQL)
def q_scan_predictions(spark, d):
    """Prediction scan (typed empty frame when absent, unioned with stored rows)."""
    path = _scratch(spark, "history")
    empty = files.read_predictions(spark, path)
    files.append_partition(_preds(spark, d), path, "scored_date")
    return empty.unionByName(files.read_predictions(spark, path).withColumn(
        "scored_date", F.col("scored_date").cast("string")))


@register("union_history", S.with_(scored=True) + f"""SELECT claim_id, {S.np_round_sql("p_denial", 4)} AS denial_probability,
  '2024-01-14' AS scored_date, NULL::VARCHAR AS model_version FROM sc
UNION ALL SELECT claim_id, {S.np_round_sql("p_denial", 4)}, '2024-01-15', '1.2.0' FROM sc""")
def q_union(spark, d):
    """History ∪ new predictions by name, new column tolerated."""
    p = SC.predict_batch(FE.features_wide(claims(spark, d))).select("claim_id", "denial_probability")
    old = p.withColumn("scored_date", F.lit("2024-01-14"))
    new = p.withColumn("scored_date", F.lit("2024-01-15")).withColumn("model_version", F.lit("1.2.0"))
    return files.union_history(old, new)


@register("published_history", _PRED_SQL)
def q_published(spark, d):
    """A day published twice; the first run's rows had another threshold."""
    path = _scratch(spark, "published")
    p = files.materialize(_preds(spark, d), _scratch(spark, "predictions"))
    PB.publish(p.withColumn("predicted_denied", F.lit(True)), path, "scored_date", [RUN_DATE])
    PB.publish(p, path, "scored_date", [RUN_DATE])
    return PB.read_published(spark, path, "scored_date")


@register("evolved_history", S.with_(scored=True) + f"""SELECT claim_id, CAST({S.np_round_sql("p_denial", 4)} AS DOUBLE) AS denial_probability,
  CAST(length(claim_id) AS BIGINT) AS id_length, NULL::VARCHAR AS model_version, '2024-01-14' AS scored_date FROM sc
UNION ALL SELECT claim_id, CAST({S.np_round_sql("p_denial", 4)} AS DOUBLE), CAST(length(claim_id) AS BIGINT), '1.2.0', '2024-01-15' FROM sc""")
def q_evolved(spark, d):
    """A later day brings a new column and a wider number; both days
    are read together."""
    path = _scratch(spark, "evolved")
    p = SC.predict_batch(FE.features_wide(claims(spark, d))).select("claim_id", "denial_probability", F.length("claim_id").alias("id_length"))
    p = files.materialize(p, _scratch(spark, "predictions"))
    PB.publish(p.withColumn("scored_date", F.lit("2024-01-14")), path, "scored_date")
    later = p.withColumn("id_length", F.col("id_length").cast("long")).withColumn("model_version", F.lit("1.2.0"))
    PB.publish(later.withColumn("scored_date", F.lit("2024-01-15")), path, "scored_date")
    return PB.read_published(spark, path, "scored_date")


_BT = f"bt AS (SELECT * FROM claims WHERE submission_date > DATE '{SINCE}')"
_DAILY_SQL = S.with_(scored=True, src="bt", rate="roll", pre=(_BT,)) + f"""SELECT claim_id,
  {S.np_round_sql("p_denial", 4)} AS denial_probability, p_denial >= 0.5 AS predicted_denied,
  {S.CONF_BATCH} AS confidence, {S.REIMB_BATCH} AS estimated_reimbursement, '{RUN_DATE}' AS scored_date FROM sc"""


@register("daily_scoring", _DAILY_SQL)
def q_daily(spark, d):
    """Q1: daily job for one run date over every claim submitted since the run
    before; returns the stored predictions."""
    out = daily_scoring(claims(spark, d), RUN_DATE, SINCE, _scratch(spark, "daily"))
    return out["predictions"].withColumn("scored_date", F.col("scored_date").cast("string"))
