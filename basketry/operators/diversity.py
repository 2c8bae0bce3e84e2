"""How different the recommended types of a list are, and how evenly types are shown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TYPE = "pdm_prod_type_id"
LEVELS = ("l1", "l2", "l3")


def type_paths(skus: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """The catalog path of every type: at each level the value most of its SKUs have, among those on the path so far.

    Equal numbers of SKUs: the smaller value, null first. A type's window holds one row per path of its SKUs.
    """
    paths = skus.groupBy(TYPE, *levels).agg(F.countDistinct("item_sku_num").alias("_n"))
    order = []
    for depth in range(1, len(levels) + 1):
        paths = paths.withColumn(f"_n{depth}", F.sum("_n").over(Window.partitionBy(TYPE, *levels[:depth])))
        order += [F.desc(f"_n{depth}"), F.asc_nulls_first(levels[depth - 1])]
    best = Window.partitionBy(TYPE).orderBy(*order)
    return paths.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1").select(TYPE, *levels)


def list_diversity(
    recs: DataFrame, paths: DataFrame, top_n: int = 10, levels: Sequence[str] = LEVELS,
    by: Sequence[str] = ("region", "focus_pdm_prod_type_id"),
) -> DataFrame:
    """(by, n_types, distance): mean distance of two types in the first `top_n` of each list.

    Two types that share the first d of L levels are 1 - d / L apart; a type without a path is 1 apart from all. No
    pair is listed: n types below one node of a level are n (n - 1) / 2 pairs that share it. Lists of fewer than two
    types have no distance. Rows without a rank are left out, repeated rows count once.
    """
    shown = recs.filter(F.col("rn") <= top_n).select(*by, F.col("recomm_pdm_prod_type_id").alias(TYPE)).distinct()
    placed = shown.join(paths.withColumn("_known", F.lit(True)), TYPE, "left")
    # A node is the path down to its level; depth 0 is the list itself. A type without a path has no node.
    nodes = [F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("node"))] + [
        F.when(F.col("_known"), F.struct(
            F.lit(depth).alias("depth"), F.array(*[F.col(c).cast("string") for c in levels[:depth]]).alias("node")
        ))
        for depth in range(1, len(levels) + 1)
    ]
    counted = placed.select(*by, F.explode(F.array_compact(F.array(*nodes))).alias("_at")).groupBy(
        *by, "_at.depth", "_at.node"
    ).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.col("_n") * (F.col("_n") - 1) / 2
    whole = F.col("depth") == 0
    lists = counted.groupBy(*by).agg(
        F.max(F.when(whole, F.col("_n"))).alias("n_types"),
        F.sum(F.when(whole, pairs)).alias("_all"),
        F.coalesce(F.sum(F.when(~whole, pairs)), F.lit(0.0)).alias("_shared"),
    )
    return lists.select(
        *by, "n_types", F.when(F.col("_all") > 0, 1 - F.col("_shared") / (len(levels) * F.col("_all"))).alias("distance")
    )


def exposure_gini(recs: DataFrame, catalog_types: DataFrame, top_n: int = 10) -> DataFrame:
    """(region, n_lists, n_shown, gini): how unevenly the region's lists show the catalog's types.

    0: all types of the catalog are shown equally often; towards 1: few types take all places. Types never shown
    count with none. The window ranks one row per type of a region.
    """
    shown = recs.filter(F.col("rn") <= top_n).select(
        "region", "focus_pdm_prod_type_id", F.col("recomm_pdm_prod_type_id").alias(TYPE)
    ).distinct()
    types = catalog_types.select(TYPE).distinct()
    n_types = types.count()
    known = shown.join(types, TYPE, "left_semi")
    per_type = known.groupBy("region", TYPE).agg(F.count(F.lit(1)).alias("_x"))
    upward = Window.partitionBy("region").orderBy("_x", TYPE)
    unseen = n_types - F.count(F.lit(1)).over(Window.partitionBy("region"))
    ranked = per_type.withColumn("_i", unseen + F.row_number().over(upward))
    lists = shown.groupBy("region").agg(F.countDistinct("focus_pdm_prod_type_id").alias("n_lists"))
    return lists.join(
        ranked.groupBy("region").agg(
            F.count(F.lit(1)).alias("n_shown"),
            (2 * F.sum(F.col("_i") * F.col("_x")) / (n_types * F.sum("_x")) - (n_types + 1) / max(n_types, 1)).alias("gini"),
        ), "region", "left",
    ).select("region", "n_lists", F.coalesce("n_shown", F.lit(0)).alias("n_shown"), "gini")


def region_diversity(recs: DataFrame, skus: DataFrame, top_n: int = 10) -> DataFrame:
    """Per region: lists, types shown, mean distance within a list, Gini index of exposure."""
    lists = list_diversity(recs, type_paths(skus), top_n).groupBy("region").agg(F.avg("distance").alias("mean_distance"))
    return exposure_gini(recs, skus, top_n).join(lists, "region").select(
        "region", "n_lists", "n_shown", "mean_distance", "gini"
    )
