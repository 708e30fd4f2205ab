"""Registered queries: the code dimensions (S6–S9) with their usage in the
claims. The dimensions themselves are fixed, bounded tables (broadcast);
the work — exploding and counting the claims' codes — grows with the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import procedures as PR
from ..sources import codes
from ..sources.fixtures import claims
from . import sqlparts as S
from .q_core import _EXPLODE_SQL
from .registry import register


def _code_usage(spark, d):
    """Occurrences per procedure code (hash aggregate, map-side combined)."""
    return PR.exploded_codes(claims(spark, d)).groupBy("cpt_code").agg(F.count(F.lit(1)).alias("n_occurrences"))


@register("dim_cpt", _EXPLODE_SQL + """, us AS (SELECT cpt_code, COUNT(*) AS n FROM ex GROUP BY cpt_code)
SELECT dim.cpt_code, dim.category, dim.is_high_cost, coalesce(us.n, 0) AS n_occurrences
FROM dim LEFT JOIN us ON dim.cpt_code = us.cpt_code""")
def q_dim_cpt(spark, d):
    """CPT → category dimension with each code's usage in the claims."""
    dim = F.broadcast(codes.dim_cpt(spark))
    return (dim.join(_code_usage(spark, d), on="cpt_code", how="left")
            .select("cpt_code", "category", "is_high_cost",
                    F.coalesce(F.col("n_occurrences"), F.lit(0)).alias("n_occurrences")))


_CAT_VALUES = ", ".join(f"({S.q(k)}, {S.q(v)})" for k, v in codes.CATEGORY_DESCRIPTIONS.items())


@register("dim_cpt_category", _EXPLODE_SQL + f""", cd AS (SELECT * FROM (VALUES {_CAT_VALUES}) t(category, description)),
us AS (SELECT coalesce(dim.category, 'other') AS category, COUNT(*) AS n
       FROM ex LEFT JOIN dim ON ex.cpt_code = dim.cpt_code GROUP BY 1),
nc AS (SELECT category, COUNT(*) AS n_codes FROM dim GROUP BY category)
SELECT cd.category, cd.description, nc.n_codes, coalesce(us.n, 0) AS n_occurrences
FROM cd JOIN nc ON cd.category = nc.category LEFT JOIN us ON cd.category = us.category""")
def q_dim_cpt_category(spark, d):
    """Category descriptions with dictionary size and usage."""
    dim = codes.dim_cpt(spark)
    usage = (PR.categorize(PR.exploded_codes(claims(spark, d))).groupBy("category")
             .agg(F.count(F.lit(1)).alias("n_occurrences")))
    n_codes = dim.groupBy("category").agg(F.count(F.lit(1)).alias("n_codes"))
    return (F.broadcast(codes.dim_cpt_category(spark)).join(F.broadcast(n_codes), on="category")
            .join(usage, on="category", how="left")
            .select("category", "description", "n_codes",
                    F.coalesce(F.col("n_occurrences"), F.lit(0)).alias("n_occurrences")))


@register("dim_high_cost", _EXPLODE_SQL + f""", hc AS (SELECT unnest({S.sql_list(codes.HIGH_COST_PROCEDURES)}) AS cpt_code),
us AS (SELECT cpt_code, COUNT(DISTINCT claim_id) AS n FROM ex GROUP BY cpt_code)
SELECT hc.cpt_code, coalesce(us.n, 0) AS n_claims FROM hc LEFT JOIN us ON hc.cpt_code = us.cpt_code""")
def q_dim_high_cost(spark, d):
    """The high-cost set with the number of claims using each code."""
    ex = PR.exploded_codes(claims(spark, d))
    usage = ex.groupBy("cpt_code").agg(F.countDistinct("claim_id").alias("n_claims"))
    return (F.broadcast(codes.dim_high_cost(spark)).join(usage, on="cpt_code", how="left")
            .select("cpt_code", F.coalesce(F.col("n_claims"), F.lit(0)).alias("n_claims")))


_POS_VALUES = ", ".join(f"({S.q(k)}, {S.q(v)}, {S.q(codes.POS_SHORT_LABELS[k])})"
                        for k, v in codes.PLACES_OF_SERVICE.items())


@register("dim_pos", "WITH " + S.claims_cte() + f""",
dim AS (SELECT * FROM (VALUES {_POS_VALUES}) t(place_of_service, pos_name, pos_label)),
us AS (SELECT place_of_service, COUNT(*) AS n FROM claims GROUP BY place_of_service)
SELECT dim.place_of_service, dim.pos_name, dim.pos_label, coalesce(us.n, 0) AS n_claims
FROM dim LEFT JOIN us ON dim.place_of_service = us.place_of_service""")
def q_dim_pos(spark, d):
    """Place-of-service dimension (long and short labels) with claim counts."""
    usage = claims(spark, d).groupBy("place_of_service").agg(F.count(F.lit(1)).alias("n_claims"))
    return (F.broadcast(codes.dim_pos(spark)).join(usage, on="place_of_service", how="left")
            .select("place_of_service", "pos_name", "pos_label",
                    F.coalesce(F.col("n_claims"), F.lit(0)).alias("n_claims")))
