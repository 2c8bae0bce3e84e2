"""Scores that plain SQL can compute too, to check ranking and reshaping apart from the models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def co_purchase_scores(ratings: DataFrame, ids: DataFrame) -> DataFrame:
    """Per region: buyers of both types / buyers of the seed's type, for every seed customer.

    Ratings hold a customer's types once each, so a customer adds at most types-squared pairs however much
    they bought, and pairs are summed before they leave a task.
    """
    bought = ratings.filter(F.col("customer_id") > 0).select("region", "customer_id", "pdm_prod_type_id")
    other = bought.withColumnRenamed("pdm_prod_type_id", "other")
    both = (
        bought.join(other, ["region", "customer_id"])
        .groupBy("region", "pdm_prod_type_id", "other").agg(F.count(F.lit(1)).alias("n"))
    )
    buyers = bought.groupBy("region", "pdm_prod_type_id").agg(F.count(F.lit(1)).alias("buyers"))
    return (
        both.join(buyers, ["region", "pdm_prod_type_id"])
        .join(ids, "pdm_prod_type_id")
        .select(
            "region",
            (-F.col("seed_id")).alias("customer_id"),
            F.col("other").alias("pdm_prod_type_id"),
            (F.col("n") / F.col("buyers")).alias("confidence"),
        )
    )


def purchase_shares(counts: DataFrame) -> DataFrame:
    """Per customer and type: the type's share of the customer's purchase lines."""
    totals = counts.groupBy("customer_id").agg(F.sum("trans_count").alias("_total"))
    return counts.join(totals, "customer_id").select(
        "customer_id", (F.col("trans_count") / F.col("_total")).alias("p"), "pdm_prod_type_id"
    )
