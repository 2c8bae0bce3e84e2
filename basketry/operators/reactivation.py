"""Purchases that brought customers back after a long gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.functions.expressions import days_between, fiscal_period, month_window
from basketry.params import ReactivationParams


def with_previous_date(
    purchases: DataFrame, customer: str, date: str, transaction: str, name: str
) -> DataFrame:
    """LAG of the date per customer in (date, transaction) order.

    Only a customer's first transaction of a day looks back to an earlier day; every other one follows a
    transaction of its own day. So the window runs over one row per customer and day, and the join that
    brings the dates back is on the unique transaction key. Neither depends on how many transactions a
    customer has. A transaction must not repeat within a customer and date.
    """
    days = purchases.groupBy(customer, date).agg(F.min(transaction).alias(transaction))
    by_day = Window.partitionBy(customer).orderBy(date)
    firsts = days.select(
        customer, date, transaction,
        F.lag(date).over(by_day).alias("_before"),
        F.lit(True).alias("_first"),
    )
    return (
        purchases.join(firsts, [customer, date, transaction], "left")
        .withColumn(name, F.when(F.col("_first"), F.col("_before")).otherwise(F.col(date)))
        .drop("_before", "_first")
    )


def valid_addresses(customers: DataFrame) -> DataFrame:
    """Customer and address of customers that are not purged and have both ids."""
    return customers.filter(
        (F.col("customer_purge_ind") == "N") & (F.col("customer_id") > 0) & (F.col("address_id") > 0)
    ).select("customer_id", "address_id")


def reactivated_purchases(
    segments: DataFrame,
    sales_line: DataFrame,
    skus: DataFrame,
    customers: DataFrame,
    params: ReactivationParams,
) -> DataFrame:
    """Lines of the transactions that reactivated a customer in the window, with SKU and address."""
    recent = month_window(F.col("transaction_booked_date"), params.as_of, params.window_months) & (
        F.col("concept_format_id") == params.concept_format_id
    )
    returned = segments.filter(recent & (F.col("segment") == "R")).select(
        "customer_guid", "transaction_guid", "transaction_booked_date"
    )
    lines = sales_line.filter(recent).select(
        "transaction_guid",
        "transaction_booked_date",
        F.col("point_of_sale_item_sku_num").alias("item_sku_num"),
    )
    addresses = valid_addresses(customers).withColumnRenamed("customer_id", "customer_guid")
    return (
        returned.join(lines, ["transaction_guid", "transaction_booked_date"])
        .join(skus, "item_sku_num", "left")
        .join(addresses, "customer_guid", "left")
        .select(
            "customer_guid", "address_id", "transaction_guid", "transaction_booked_date",
            F.col("item_sku_num").alias("point_of_sale_item_sku_num"),
            "pdm_prod_type_id", "item_sku_desc", "pdm_prod_type_desc",
        )
    )


def sale_transactions(sales_txn: DataFrame, xref: DataFrame, params: ReactivationParams) -> DataFrame:
    """Customer, date and transaction of sales counted up to the day of the run."""
    sales = sales_txn.filter(
        (F.col("concept_format_id") == params.concept_format_id)
        & (F.col("transaction_booked_date") <= F.lit(params.as_of))
        & F.col("gross_sales").isNotNull()
        & F.col("sales_transaction_type_code").isin(*params.sale_types)
    ).select("transaction_guid", "transaction_booked_date")
    owners = xref.filter(F.col("customer_id") > 0).withColumnRenamed("trans_id", "transaction_guid")
    return sales.join(owners, "transaction_guid").select(
        "customer_id", "transaction_booked_date", "transaction_guid"
    )


def purchase_gaps(
    sales_txn: DataFrame, xref: DataFrame, reactivated: DataFrame, params: ReactivationParams
) -> DataFrame:
    """All sales of reactivated customers with the date before, the gap and both fiscal periods."""
    customers = reactivated.select(F.col("customer_guid").alias("customer_id")).distinct()
    history = (
        sale_transactions(sales_txn, xref, params).join(customers, "customer_id", "left_semi").distinct()
    )
    dated = with_previous_date(
        history, "customer_id", "transaction_booked_date", "transaction_guid", "previous_buy"
    )
    bought = F.col("transaction_booked_date")
    return dated.select(
        "customer_id",
        "transaction_guid",
        bought.alias("reactivation_purchase"),
        F.trunc(bought, "MONTH").alias("reactivation_month"),
        "previous_buy",
        fiscal_period(F.col("previous_buy"), params.period_lag_months).alias("FP"),
        fiscal_period(bought, params.period_lag_months).alias("FP2"),
        days_between(bought, F.col("previous_buy")).alias("time_interval"),
    )


def top_reactivation_types(
    reactivated: DataFrame, limit: int = 100, skip: int = 0, keep_null: bool = True
) -> DataFrame:
    """Types by number of reactivation lines; the first `skip` are left out.

    A null type takes a place unless `keep_null` is off.
    """
    counts = reactivated.groupBy("pdm_prod_type_id").agg(F.count("customer_guid").alias("n_purchases"))
    if not keep_null:
        counts = counts.filter(F.col("pdm_prod_type_id").isNotNull())
    order = [F.desc("n_purchases"), F.asc_nulls_last("pdm_prod_type_id")]
    top = counts.orderBy(*order).limit(limit)
    if not skip:
        return top
    # At most `limit` rows are left to number.
    place = F.row_number().over(Window.orderBy(*order))
    return top.withColumn("_place", place).filter(F.col("_place") > skip).drop("_place")


def reactivation_base(reactivated: DataFrame, gaps: DataFrame, params: ReactivationParams) -> DataFrame:
    """One row per customer, reactivation and product type, for gaps in the accepted range."""
    # limit() bounds this side to params.top_types rows.
    types = F.broadcast(
        top_reactivation_types(reactivated, params.top_types, keep_null=params.keep_null_type)
        .select("pdm_prod_type_id")
    )
    accepted = gaps.filter(
        (F.col("previous_buy") >= F.lit(params.earliest_previous))
        & F.col("time_interval").between(params.min_gap_days, params.max_gap_days)
    )
    return (
        reactivated.withColumnRenamed("customer_guid", "customer_id")
        .join(types, "pdm_prod_type_id", "left_semi")
        .join(accepted, ["customer_id", "transaction_guid"])
        .select(
            "customer_id", "address_id", "reactivation_purchase", "previous_buy", "FP", "FP2",
            "time_interval", "pdm_prod_type_id", "pdm_prod_type_desc",
        )
        .distinct()
    )


def last_purchases(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("customer_id").agg(
        F.max("transaction_booked_date").alias("latest_purchase")
    )


def at_risk_lapsed(sales_txn: DataFrame, xref: DataFrame, params: ReactivationParams) -> DataFrame:
    """Customers by time since any purchase: lapsed beyond a year, at risk beyond half a year."""
    owners = xref.filter(F.col("customer_id") > 0).withColumnRenamed("trans_id", "transaction_guid")
    past = sales_txn.filter(F.col("transaction_booked_date") <= F.lit(params.as_of)).join(
        owners, "transaction_guid"
    )
    days = F.datediff(F.lit(params.as_of), F.col("latest_purchase"))
    return (
        last_purchases(past)
        .withColumn(
            "status",
            F.when(days > params.lapsed_days, "lapsed").when(days >= params.at_risk_days, "at risk"),
        )
        .filter(F.col("status").isNotNull())
        .select("customer_id", "status")
    )


def scoring_customers(
    sales_txn: DataFrame,
    xref: DataFrame,
    listed: DataFrame,
    customers: DataFrame,
    params: ReactivationParams,
) -> DataFrame:
    """Listed customers with their last counted sale, the days since and their address.

    Sales are reduced to one row per customer before the list and the addresses are joined.
    """
    today = F.lit(params.as_of).cast("date")
    latest = last_purchases(sale_transactions(sales_txn, xref, params))
    return (
        latest.join(listed.select("customer_id").distinct(), "customer_id", "left_semi")
        .join(valid_addresses(customers), "customer_id", "left")
        .select(
            "customer_id",
            "latest_purchase",
            fiscal_period(today, params.period_lag_months).alias("FP"),
            days_between(today, F.col("latest_purchase")).alias("time_interval"),
            "address_id",
        )
    )
