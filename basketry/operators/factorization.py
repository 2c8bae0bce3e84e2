"""One implicit-feedback factor model per region."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.lineage import staged, use_checkpoints
from basketry.functions.numbering import consecutive
from basketry.params import FactorParams


def indexed_ratings(ratings: DataFrame, ids: DataFrame) -> DataFrame:
    """Ratings with 32-bit user and item numbers, written once, one partition per region.

    The factor model only takes 32-bit ids, while customer and type ids are 64-bit.
    """
    users = ratings.select("customer_id").distinct()
    numbered = consecutive(users, [F.col("customer_id")], "user_index")
    rows = (
        ratings.join(numbered, "customer_id")
        .join(ids, "pdm_prod_type_id")
        .select(
            "region",
            "customer_id",
            "pdm_prod_type_id",
            F.col("user_index").cast("int"),
            F.col("seed_id").cast("int").alias("item_index"),
            F.col("trans_count").cast("float").alias("rating"),
        )
    )
    return staged(rows, "ratings", partition_by=("region",))


def fit_regional_als(
    indexed: DataFrame, regions: Sequence[str], params: FactorParams
) -> dict[str, ALSModel]:
    """A model per region, several fits at a time. Every region holds the seed rows, so none is empty."""
    spark = indexed.sparkSession
    use_checkpoints(spark)
    als = ALS(
        userCol="user_index",
        itemCol="item_index",
        ratingCol="rating",
        implicitPrefs=True,
        rank=params.rank,
        regParam=params.reg_param,
        alpha=params.alpha,
        maxIter=params.max_iter,
        seed=params.seed,
        coldStartStrategy="drop",
        numUserBlocks=params.user_blocks or spark.sparkContext.defaultParallelism,
        numItemBlocks=params.item_blocks,
    )

    def fit(region: str) -> ALSModel:
        return als.fit(indexed.filter(F.col("region") == region))

    with ThreadPoolExecutor(params.parallelism) as pool:
        return dict(zip(regions, pool.map(fit, regions)))


def seed_scores(models: Mapping[str, ALSModel], indexed: DataFrame, top: int) -> DataFrame:
    """The `top` best types for every seed customer: region, customer_id, pdm_prod_type_id, confidence.

    Only seed customers are scored, so the users-by-items product is types by types, whatever the number
    of customers.
    """
    seeds = indexed.filter(F.col("customer_id") < 0).select("region", "customer_id", "user_index")
    items = indexed.filter(F.col("customer_id") < 0).select(
        "region", "item_index", "pdm_prod_type_id"
    ).distinct()
    frames = []
    for region, model in models.items():
        users = seeds.filter(F.col("region") == region).select("user_index").distinct()
        # All items are fetched and cut afterwards, so equal scores at the cut go by id.
        best = model.recommendForUserSubset(users, model.itemFactors.count())
        frames.append(best.select(F.lit(region).alias("region"), "user_index", F.inline("recommendations")))
    scored = frames[0]
    for frame in frames[1:]:
        scored = scored.unionByName(frame)
    best_first = Window.partitionBy("region", "customer_id").orderBy(F.desc("confidence"), "pdm_prod_type_id")
    return (
        scored.join(seeds, ["region", "user_index"])
        .join(items, ["region", "item_index"])
        .select(
            "region",
            "customer_id",
            "pdm_prod_type_id",
            F.col("rating").cast("double").alias("confidence"),
        )
        .withColumn("_place", F.row_number().over(best_first))
        .filter(F.col("_place") <= top)
        .drop("_place")
    )


def save_models(models: Mapping[str, ALSModel], folder: str) -> None:
    for region, model in models.items():
        model.write().overwrite().save(f"{folder}/region={region}")


def load_models(folder: str, regions: Sequence[str]) -> dict[str, ALSModel]:
    return {region: ALSModel.load(f"{folder}/region={region}") for region in regions}
