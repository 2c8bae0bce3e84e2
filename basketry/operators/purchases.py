"""Purchases of known customers inside a recent window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.expressions import month_window, unit_price
from basketry.params import PairParams
from basketry.sources.storage import MONTH, month_number


def known_buyers(lines: DataFrame, xref: DataFrame, customers: DataFrame) -> DataFrame:
    """The lines with the id of their customer, for customers that are not purged.

    Lines meet the cross-reference first: they are cut to a window already, so only the transactions they name
    are looked up by customer. The customers' distinct ids are joined as rows: the optimizer would carry a semi join
    below the first join, and move the whole cross-reference by customer.
    """
    owners = xref.filter(F.col("customer_id") > 0).withColumnRenamed("trans_id", "transaction_guid")
    current = customers.filter((F.col("customer_purge_ind") == "N") & (F.col("customer_id") > 0))
    return lines.join(owners, "transaction_guid").join(current.select("customer_id").distinct(), "customer_id")


def base_transactions(
    sales_line: DataFrame,
    xref: DataFrame,
    customers: DataFrame,
    skus: DataFrame,
    params: PairParams,
    days: Callable[[Column], Column] | None = None,
    months: Sequence[int] | None = None,
) -> DataFrame:
    """Purchase lines of the window, each distinct line once, with customer and SKU attributes.

    `days`, if given, tells the days wanted instead of the window, and `months` (YYYYMM) the months they are in.

    Lines stored by month are read from the folders of the window's or the given months only.

    Lines are deduplicated while they hold ids, price and units only; the wide text columns are joined to
    the distinct rows. Every column of `skus` is part of the result, so this equals deduplicating at the end.
    """
    booked = F.col("transaction_booked_date")
    if MONTH in sales_line.columns and days is None:
        sales_line = sales_line.filter(F.col(MONTH).between(
            F.date_format(F.add_months(F.lit(params.as_of), -params.window_months), "yyyyMM").cast("int"),
            month_number(params.as_of),
        ))
    elif MONTH in sales_line.columns and months is not None:
        sales_line = sales_line.filter(F.col(MONTH).isin(*months))
    lines = sales_line.filter(
        (days(booked) if days else month_window(booked, params.as_of, params.window_months))
        & (F.col("concept_format_id") == params.concept_format_id)
    ).select(
        "transaction_guid",
        F.col("point_of_sale_item_sku_num").alias("item_sku_num"),
        "transaction_booked_date",
        unit_price(F.col("gross_sales"), F.col("sold_units")).alias("sku_price"),
        "sold_units",
    )
    return (
        known_buyers(lines, xref, customers)
        .distinct()
        .join(skus, "item_sku_num")
        .select(
            "customer_id", "transaction_guid", "pdm_prod_type_desc", "pdm_prod_type_id",
            "item_sku_num", "item_sku_desc", "l1", "l2", "l3", "l4",
            "transaction_booked_date", "sku_price", "sold_units",
            F.lit(1).cast("bigint").alias("buy_flag"),
        )
    )


def customer_type_counts(base: DataFrame) -> DataFrame:
    """Purchase lines per customer and product type."""
    return base.groupBy("customer_id", "pdm_prod_type_id").agg(
        F.count("transaction_guid").alias("trans_count")
    )


def multi_type_customers(counts: DataFrame, min_types: int = 2) -> DataFrame:
    """Customers who bought at least `min_types` product types."""
    return (
        counts.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_types"))
        .filter(F.col("n_types") >= min_types)
    )


def supported_types(counts: DataFrame, min_rows: int) -> DataFrame:
    """Counts of the types that at least `min_rows` customers bought."""
    if min_rows <= 1:
        return counts
    common = counts.groupBy("pdm_prod_type_id").agg(F.count(F.lit(1)).alias("_n"))
    return counts.join(
        common.filter(F.col("_n") >= min_rows).select("pdm_prod_type_id"), "pdm_prod_type_id", "left_semi"
    )


def supported_ratings(ratings: DataFrame, counts: DataFrame, min_customers: int) -> DataFrame:
    """Ratings of the types that at least `min_customers` customers bought.

    Support is counted before customers are repeated by region and seed rows are added.
    """
    if min_customers <= 1:
        return ratings
    types = supported_types(counts, min_customers).select("pdm_prod_type_id").distinct()
    return ratings.join(types, "pdm_prod_type_id", "left_semi")
