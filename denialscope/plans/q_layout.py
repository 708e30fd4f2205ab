"""Registered queries over tables laid out for their readers: point lookups
(P1), joins without a shuffle (J1, J7), stored quantile sketches (A10, A11)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import history as H
from ..operators import scoring as SC
from ..operators import sketches as K
from ..session import scratch_path
from ..sources import colocated as CO
from ..sources import files, lookup
from ..sources.fixtures import claims
from . import sqlparts as S
from .q_core import LOOKUP_ID_SQL
from .registry import ORACLE, register

_C = "WITH " + S.claims_cte() + "\n"
BUCKETS = 16


def _scratch(spark, name):
    return scratch_path(spark, f"queries/{name}/{uuid.uuid4().hex}")


def _bucketed(spark, df, name, key, like=None):
    run = uuid.uuid4().hex
    return CO.write_colocated(df, f"denialscope_{name}_{run}", scratch_path(spark, f"queries/{name}/{run}"), key, BUCKETS, like)


@register("lookup_indexed", _C + f"SELECT claim_id, claim_type, billed_amount, is_denied FROM claims WHERE claim_id = {LOOKUP_ID_SQL}")
def q_lookup_indexed(spark, d):
    """Exact match in a table written for lookups."""
    path = _scratch(spark, "lookup")
    lookup.write_lookup(claims(spark, d), path)
    table = lookup.read_lookup(spark, path)
    wanted = table.where("claim_type = 'dental'").agg(F.min("claim_id")).first()[0]
    return lookup.find(table, [wanted] if wanted else []).select("claim_id", "claim_type", "billed_amount", "is_denied")


@register("join_provider_stats_colocated", ORACLE["join_provider_stats"])
def q_join_provider_colocated(spark, d):
    """J1 over claims bucketed by provider."""
    rows = _bucketed(spark, claims(spark, d).select("claim_id", "provider_npi", "is_denied"), "providers", "provider_npi")
    return CO.join_group(spark, rows, H.provider_stats).select(
        "claim_id", "provider_npi", F.col("total_denied").cast("double").alias("total_denied"),
        F.col("total_claims").cast("double").alias("total_claims"))


@register("join_predictions_colocated", ORACLE["join_predictions_claims"])
def q_join_predictions_colocated(spark, d):
    """J7 over claims and predictions bucketed by claim id. The claims are
    derived once: both tables' buckets, hot keys and rates read the copy."""
    c = files.materialize(claims(spark, d), _scratch(spark, "claims"))
    left = _bucketed(spark, c.select("claim_id", "claim_type", "is_denied"), "claims", "claim_id")
    preds = SC.predict_batch(FE.features_wide(c)).select("claim_id", "denial_probability", "predicted_denied")
    right = _bucketed(spark, preds, "predictions", "claim_id", left)
    return CO.join_colocated(spark, left, right)


@register("kpi_billed_quantiles_sketch", _C + """SELECT q, (SELECT COUNT(billed_amount) FROM claims) AS n, true AS within_bound
FROM (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.95 AS DOUBLE))) t(q)""")
def q_sketch_quantiles(spark, d):
    """Quantiles of all days' stored sketches; ``n`` is the sketches'
    own count, and ``within_bound`` compares the value's exact rank."""
    c = claims(spark, d)
    stored = files.materialize(K.day_sketches(c), _scratch(spark, "sketches"))
    got = files.materialize(K.merged_quantiles(stored), _scratch(spark, "quantiles"))
    off = F.greatest(F.col("below") - F.col("q"), F.col("q") - F.col("at_most"))
    return got.join(K.ranks(c, got), "q").select("q", "n", (off <= 2 * K.rank_error()).alias("within_bound"))
