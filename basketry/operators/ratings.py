"""Ratings per region: what customers bought, plus one seed customer per product type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.numbering import consecutive


def surrogate_ids(counts: DataFrame) -> DataFrame:
    """Product types numbered 1..N by id."""
    types = counts.select("pdm_prod_type_id").distinct()
    return consecutive(types, [F.col("pdm_prod_type_id")], "seed_id")


def item_seed_rows(ids: DataFrame) -> DataFrame:
    """One purchase of every type by its seed customer. Seed ids are negative: no customer has one."""
    return ids.select(
        (-F.col("seed_id")).alias("customer_id"),
        "pdm_prod_type_id",
        F.lit(1).cast("bigint").alias("trans_count"),
    )


def regional_ratings(
    counts: DataFrame, customer_region: DataFrame, seeds: DataFrame, regions: Sequence[str]
) -> DataFrame:
    """Ratings of all regions in one table; every region gets all seed rows."""
    columns = ["region", "customer_id", "pdm_prod_type_id", "trans_count"]
    bought = counts.join(customer_region, "customer_id").select(*columns)
    planted = seeds.withColumn("region", F.explode(F.array(*[F.lit(r) for r in regions])))
    return bought.unionByName(planted.select(*columns))
