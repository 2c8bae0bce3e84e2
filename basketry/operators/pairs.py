"""SKU pairs bought by the same customers, for recommended type pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.lineage import staged
from basketry.functions.numbering import consecutive_within

# Focus SKUs of one basket that may meet the basket's recommended SKUs in one task.
BASKET_CHUNK = 2000


def tag_regions(base: DataFrame, customer_region: DataFrame) -> DataFrame:
    """Purchases with the region of their customer; customers outside `customer_region` are left out."""
    return base.join(customer_region, "customer_id")


def _chunked(side: DataFrame, heavy: DataFrame, keys: Sequence[str], chunk: Column) -> DataFrame:
    chunks = F.coalesce(F.col("_chunks"), F.lit(1))
    return side.join(heavy, list(keys), "left").withColumn("_chunk", chunk(chunks)).drop("_chunks")


def basket_items(history: DataFrame, group: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Purchase lines per basket and SKU."""
    return history.groupBy(*group, "pdm_prod_type_id", "item_sku_num").agg(F.count(F.lit(1)).alias("n"))


def reference_types(reference: DataFrame, by: Sequence[str] = ("region",)) -> DataFrame:
    """Each focus type that is listed for itself (rank 0) with the other types it recommends, written once."""
    listed = reference.select(
        *by,
        F.col("focus_pdm_prod_type_id").alias("pdm_prod_type_id"),
        F.col("recomm_pdm_prod_type_id").alias("_type"),
    ).distinct()
    own = F.col("_type") == F.col("pdm_prod_type_id")
    return staged(
        listed.filter(~own).join(
            listed.filter(own).drop("_type"), [*by, "pdm_prod_type_id"], "left_semi"
        ),
        "type_pairs",
    )


def pair_counts(
    focus_items: DataFrame,
    other_items: DataFrame,
    types: DataFrame,
    by: Sequence[str] = ("region",),
    basket_key: str = "customer_id",
    distinct_baskets: bool = False,
    chunk: int = BASKET_CHUNK,
) -> DataFrame:
    """Products of the counts n of the focus and the other SKUs of a basket, summed by SKU pair.

    Counts may be signed. Baskets with more than `chunk` focus SKUs are cut by focus SKU: each part joins a copy
    of the basket's other SKUs in a task of its own. Both sides must be written tables.
    """
    group = [*by, basket_key]
    sizes = focus_items.groupBy(*group).agg(F.count(F.lit(1)).alias("_skus"))
    heavy = staged(
        sizes.filter(F.col("_skus") > chunk).select(
            *group, F.ceil(F.col("_skus") / chunk).cast("int").alias("_chunks")
        ),
        "heavy_baskets",
    )
    focus = _chunked(
        focus_items.join(types, [*by, "pdm_prod_type_id"]), heavy, group,
        lambda chunks: F.pmod(F.xxhash64("item_sku_num"), chunks).cast("int"),
    ).select(*group, "_type", "_chunk", F.col("item_sku_num").alias("Focus"), F.col("n").alias("_n"))
    other = _chunked(
        other_items, heavy, group, lambda chunks: F.explode(F.sequence(F.lit(0), chunks - 1))
    ).select(
        *group,
        F.col("pdm_prod_type_id").alias("_type"),
        "_chunk",
        F.col("item_sku_num").alias("Recomm"),
        F.col("n").alias("_m"),
    )
    weight = F.lit(1) if distinct_baskets else F.col("_n") * F.col("_m")
    return (
        focus.join(other, [*group, "_type", "_chunk"])
        .groupBy(*by, "Focus", "Recomm")
        .agg(F.sum(weight).cast("bigint").alias("count"))
    )


def sku_pairs(
    history: DataFrame,
    reference: DataFrame,
    basket_key: str = "customer_id",
    by: Sequence[str] = ("region",),
    distinct_baskets: bool = False,
    chunk: int = BASKET_CHUNK,
) -> DataFrame:
    """How often a SKU of the focus type and a SKU of a recommended type share a basket.

    Purchases are first counted per basket and SKU, so a basket repeated in many lines weighs no more than
    its distinct SKUs, and n focus and m other purchases add n*m pairs without listing them (1 with
    `distinct_baskets`). A basket only meets the types its focus types recommend; a focus type that is not
    listed for itself (rank 0) is no focus.

    The counts are written once for the two sides of the join, and the type pairs and heavy baskets so that
    the planner knows their size: it broadcasts them only if they are small.
    """
    items = staged(basket_items(history, [*by, basket_key]), "basket_items")
    types = reference_types(reference, by)
    return pair_counts(items, items, types, by, basket_key, distinct_baskets, chunk)


def sku_recommendations(
    pairs: DataFrame, skus: DataFrame, reference: DataFrame, by: Sequence[str] = ("region",)
) -> DataFrame:
    """SKU pairs with the attributes of both SKUs, the rank of the type pair and the rank within it.

    A type pair can hold as many rows as its SKUs allow, so ranks come from one global numbering rather
    than from a window per pair. Only ids and counts are numbered; the texts are joined to the ranked pairs.
    """
    def typed(prefix: str, key: str) -> DataFrame:
        return skus.select(
            F.col("item_sku_num").alias(key), F.col("pdm_prod_type_id").alias(f"{prefix}_pdm_prod_type_id")
        ).distinct()

    def described(prefix: str, key: str) -> DataFrame:
        return skus.select(
            F.col("item_sku_num").alias(key),
            F.col("pdm_prod_type_id").alias(f"{prefix}_pdm_prod_type_id"),
            F.col("pdm_prod_type_desc").alias(f"{prefix}_type"),
            F.col("item_sku_desc").alias(f"{prefix}_sku"),
            *[F.col(level).alias(f"{prefix}_{level}") for level in ("l1", "l2", "l3", "l4")],
        )

    type_pair = [*by, "focus_pdm_prod_type_id", "recomm_pdm_prod_type_id"]
    narrow = pairs.select(*by, "Focus", "Recomm", "count").join(typed("focus", "Focus"), "Focus", "left").join(
        typed("recomm", "Recomm"), "Recomm", "left"
    )
    ranked = consecutive_within(
        narrow, type_pair, [F.desc("count"), F.col("Focus"), F.col("Recomm")], "sku_rank"
    )
    ranks = reference.select(*type_pair, F.col("product_type_rank").alias("rn"))
    return (
        ranked.join(ranks, type_pair, "left")
        .join(described("focus", "Focus"), ["Focus", "focus_pdm_prod_type_id"], "left")
        .join(described("recomm", "Recomm"), ["Recomm", "recomm_pdm_prod_type_id"], "left")
        .withColumnsRenamed({"Focus": "focus_sku_num", "Recomm": "recomm_sku_num"})
    )
