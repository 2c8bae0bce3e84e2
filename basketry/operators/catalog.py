"""Products: SKU dimension, full catalog, product types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.expressions import valid_type
from basketry.functions.numbering import consecutive

ATTRIBUTES = ("item_sku_num", "pdm_prod_type_id", "item_sku_desc", "pdm_prod_type_desc", "l1", "l2", "l3", "l4")


def _typed_skus(item_sku: DataFrame, prod_type: DataFrame) -> DataFrame:
    types = prod_type.filter(valid_type("pdm_prod_type_id", "pdm_prod_type_desc"))
    return item_sku.filter(F.col("pdm_prod_type_id") > 0).join(types, "pdm_prod_type_id")


def sku_dimension(item_sku: DataFrame, prod_type: DataFrame, sku_levels: DataFrame) -> DataFrame:
    """SKUs of valid product types with their descriptions and levels."""
    return (
        _typed_skus(item_sku.drop("class_id"), prod_type)
        .join(sku_levels, "item_sku_num")
        .select(*ATTRIBUTES)
        .distinct()
    )


def catalog_rows(
    item_sku: DataFrame,
    prod_type: DataFrame,
    sku_levels: DataFrame,
    class_code: DataFrame,
    sub_department: DataFrame,
    department: DataFrame,
    item_category: DataFrame,
) -> DataFrame:
    """SKU dimension plus the merchandise hierarchy."""
    return (
        _typed_skus(item_sku, prod_type)
        .join(sku_levels, "item_sku_num")
        .join(class_code, "class_id")
        .join(sub_department, "sub_department_id")
        .join(department, "department_id")
        .join(item_category, "item_category_cd")
        .select(
            *ATTRIBUTES,
            "item_category_cd", "item_category_desc",
            "department_cd", "department_id", "department_name",
            "sub_department_cd", "sub_department_id", "sub_department_name",
            "class_cd", "class_name",
        )
        .distinct()
    )


def sku_catalog(rows: DataFrame) -> DataFrame:
    """Catalog rows numbered by SKU.

    Every row can stand for a purchase by a made-up customer: its number is both the transaction and the
    customer id. Rows are deduplicated before they are numbered.
    """
    order = [F.col("item_sku_num"), *(F.col(c) for c in rows.columns if c != "item_sku_num")]
    numbered = consecutive(rows, order, "transaction_guid")
    return numbered.select(
        "item_sku_num",
        "transaction_guid",
        F.col("transaction_guid").alias("customer_id"),
        F.lit(1).cast("bigint").alias("buy_flag"),
        *rows.columns[1:],
    )


def catalog_skus(rows: DataFrame) -> DataFrame:
    """SKU, type and their descriptions."""
    return rows.select(*ATTRIBUTES[:4]).distinct()


def types_per_level(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("l1").agg(F.countDistinct("pdm_prod_type_id").alias("n_types"))
