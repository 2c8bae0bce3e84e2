"""From scores to ranked recommendations per focus type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

USER = ("region", "customer_id")
FOCUS = ("region", "focus_pdm_prod_type_id")


def candidate_lists(scores: DataFrame) -> DataFrame:
    """All candidates of a user as one array, best first, equal scores by type id.

    An array holds a user's candidates, at most one per product type.
    """
    candidate = F.struct((-F.col("confidence")).alias("key"), "pdm_prod_type_id", "confidence")
    ordered = F.sort_array(F.collect_list(candidate))
    return scores.groupBy(*USER).agg(
        F.transform(
            ordered,
            lambda c: F.struct(
                c["pdm_prod_type_id"].alias("pdm_prod_type_id"), c["confidence"].alias("confidence")
            ),
        ).alias("recommended")
    )


def flatten_candidates(lists: DataFrame) -> DataFrame:
    """One row per candidate; the rank is the place in the array."""
    return lists.select(*USER, F.posexplode("recommended").alias("_place", "_c")).select(
        *USER,
        F.col("_c.pdm_prod_type_id").alias("pdm_prod_type_id"),
        F.col("_c.confidence").alias("confidence"),
        (F.col("_place") + 1).cast("bigint").alias("rn"),
    )


def rank_candidates(scores: DataFrame) -> DataFrame:
    """The same ranks straight from the flat scores. A user's window holds one row per product type."""
    best = Window.partitionBy(*USER).orderBy(F.desc("confidence"), "pdm_prod_type_id")
    return scores.withColumn("rn", F.row_number().over(best).cast("bigint"))


def recommend_types(
    ranked: DataFrame, seeds: DataFrame, prod_type: DataFrame, rank_limit: int = 50
) -> DataFrame:
    """Recommended types per region and focus type.

    The rank limit counts the focus type itself; it is removed afterwards and the rest ranked anew, so a
    focus type has `rank_limit` rows or one less.
    """
    kept = ranked.filter(F.col("rn") <= rank_limit)
    focus = seeds.select("customer_id", F.col("pdm_prod_type_id").alias("focus_pdm_prod_type_id"))
    names = prod_type.select("pdm_prod_type_id", "pdm_prod_type_desc")
    final = Window.partitionBy(*FOCUS).orderBy(F.desc("confidence"), "recomm_pdm_prod_type_id")
    return (
        kept.withColumnRenamed("pdm_prod_type_id", "recomm_pdm_prod_type_id")
        .join(focus, "customer_id")
        .filter(F.col("focus_pdm_prod_type_id") != F.col("recomm_pdm_prod_type_id"))
        .join(
            names.toDF("focus_pdm_prod_type_id", "focus_type"), "focus_pdm_prod_type_id"
        )
        .join(
            names.toDF("recomm_pdm_prod_type_id", "recomm_type"), "recomm_pdm_prod_type_id"
        )
        .select(
            *FOCUS,
            "focus_type",
            "recomm_pdm_prod_type_id",
            "recomm_type",
            F.col("confidence").alias("predicted_trans_count_confidence"),
            F.row_number().over(final).cast("bigint").alias("rn"),
        )
    )


def get_recommendations(recs: DataFrame, product_id: int, region: str, top_n: int = 5) -> DataFrame:
    """Best types for one focus type in one region, in rank order."""
    wanted = (F.col("focus_pdm_prod_type_id") == product_id) & (F.col("region") == region)
    return recs.filter(wanted & (F.col("rn") <= top_n)).orderBy("rn")


def without_bought(recs: DataFrame, counts: DataFrame, key: str = "customer_id") -> DataFrame:
    """Drop the types a customer already bought."""
    return recs.join(counts.select(key, "pdm_prod_type_id"), [key, "pdm_prod_type_id"], "left_anti")


def type_pair_reference(recs: DataFrame, max_rank: int = 4, max_sku_rank: int = 1) -> DataFrame:
    """Type pairs to mine SKUs for: the first `max_rank` recommendations and the focus type at rank 0.

    `recs` has rn as the type rank and may have sku_rank.
    """
    kept = F.col("rn") <= max_rank
    if "sku_rank" in recs.columns:
        kept = kept & (F.col("sku_rank") <= max_sku_rank)
    own = F.struct(
        F.lit(0).cast("bigint").alias("product_type_rank"),
        F.col("focus_pdm_prod_type_id").alias("recomm_pdm_prod_type_id"),
    )
    pair = F.struct(F.col("rn").cast("bigint").alias("product_type_rank"), "recomm_pdm_prod_type_id")
    return recs.select(
        *FOCUS, F.inline(F.when(kept, F.array(own, pair)).otherwise(F.array(own)))
    ).distinct()
