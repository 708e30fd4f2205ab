"""Procedure-code operators over exploded code lists.

The CPT dimension has a fixed size (71 codes), so joining it is always a
broadcast hash join; the claims side is never shuffled for it. What is asked
of one claim's codes is computed on its own list, without an explode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import proc_array
from ..sources import codes

OTHER = "other"


def exploded_codes(claims: DataFrame, keep: tuple[str, ...] = ("claim_id",)) -> DataFrame:
    """One row per (claim, position, procedure code)."""
    return claims.select(*keep, F.posexplode(proc_array(F.col("procedure_codes"))).alias("pos", "cpt_code"))


def categorize(exploded: DataFrame) -> DataFrame:
    """Broadcast left join to the CPT dimension; unknown → 'other'."""
    dim = F.broadcast(codes.dim_cpt(exploded.sparkSession))
    return (exploded.join(dim, on="cpt_code", how="left")
            .withColumn("category", F.coalesce(F.col("category"), F.lit(OTHER)))
            .withColumn("is_high_cost", F.coalesce(F.col("is_high_cost"), F.lit(False))))


def _categories(claims: DataFrame) -> DataFrame:
    """(claim_id, __cats): the category of every code of the claim."""
    lookup = F.create_map(*[F.lit(x) for pair in codes.CPT_TO_CATEGORY.items() for x in pair])
    cats = F.transform(proc_array(F.col("procedure_codes")), lambda c: F.coalesce(F.try_element_at(lookup, c), F.lit(OTHER)))
    return claims.select("claim_id", cats.alias("__cats"))


def procedure_complexity(claims: DataFrame) -> DataFrame:
    """(claim, category) → number of codes in that category. Counted
    inside the claim's row: nothing is shuffled."""
    per = F.transform(F.array_distinct("__cats"), lambda c: F.struct(
        c.alias("category"), F.size(F.filter("__cats", lambda x: x == c)).cast("long").alias("n_codes")))
    return _categories(claims).select("claim_id", F.inline(per))


def category_flags(claims: DataFrame) -> DataFrame:
    """Per claim, 0/1 flags for the four modelled categories (claims
    without codes get zeros)."""
    wanted = {"has_surgery": "surgery", "has_radiology": "radiology",
              "has_pathology": "pathology", "has_eval_mgmt": "evaluation_management"}
    return _categories(claims).select("claim_id", *[F.array_contains("__cats", c).cast("int").alias(n) for n, c in wanted.items()])


def high_cost_claims(claims: DataFrame) -> DataFrame:
    """Claims having at least one high-cost code: membership of the fixed
    set, tested on the claim's own list."""
    wanted = F.array(*[F.lit(c) for c in codes.HIGH_COST_PROCEDURES])
    return claims.where(F.arrays_overlap(proc_array(F.col("procedure_codes")), wanted))


def pos_labels(claims: DataFrame) -> DataFrame:
    """Short POS label by broadcast left join; unmatched → 'Other'."""
    dim = F.broadcast(codes.dim_pos(claims.sparkSession).select("place_of_service", "pos_label"))
    return (claims.join(dim, on="place_of_service", how="left")
            .withColumn("pos_label", F.coalesce(F.col("pos_label"), F.lit("Other"))))
