"""Input tables of the jobs and the generic table reads."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns the jobs use of every input.
INPUTS = {
    "item_sku": ("item_sku_num", "pdm_prod_type_id", "item_sku_desc", "class_id"),
    "pdm_prod_type": ("pdm_prod_type_id", "pdm_prod_type_desc"),
    "sku_levels": ("item_sku_num", "l1", "l2", "l3", "l4"),
    "class_code": ("class_id", "class_cd", "class_name", "sub_department_id"),
    "sub_department": (
        "sub_department_id", "sub_department_cd", "sub_department_name", "department_id",
    ),
    "department": ("department_id", "department_cd", "department_name", "item_category_cd"),
    "item_category": ("item_category_cd", "item_category_desc"),
    "sales_line": (
        "transaction_guid", "point_of_sale_item_sku_num", "transaction_booked_date",
        "gross_sales", "sold_units", "concept_format_id",
    ),
    "sales_txn": (
        "transaction_guid", "transaction_booked_date", "gross_sales",
        "sales_transaction_type_code", "concept_format_id",
    ),
    "customer_txn_xref": ("trans_id", "customer_id"),
    "customer_segments": (
        "customer_guid", "transaction_guid", "transaction_booked_date", "concept_format_id", "segment",
    ),
    "customer_curr": ("customer_id", "customer_purge_ind", "address_id"),
    "customer_address": ("customer_id", "address_id", "prefd_cust_ind"),
    "address_mstr": ("address_id", "mailing_address_id"),
    "mailing_address": ("mailing_address_id", "territory_cd"),
    "address_demographics": (
        "address_guid", "fiscal_period_id", "A_A7478N_NEW_MOVER_YES", "A_A8588N_HM_SQR_FT",
        "A_A3101N_RACE_WHITE", "A_AAP000447N_ASET_PRPN_DIS_INC",
    ),
    "address_rfm": (
        "address_guid", "fiscal_period_id", "beyond_recency_two_years",
        "beyond_instore_monetary_decile_two_years",
    ),
    "address_promo": ("address_guid", "fiscal_period_id", "PH_DM_RECENCY", "PH_MREDEEM730D_PERC"),
    "address_seasonality": ("address_guid", "fiscal_period_id", "COUPON_SALES_Q_08"),
    "shopping_metrics": (
        "address_guid", "fiscal_period_id", "avg_items_per_transaction",
        "avg_net_sales_per_transaction", "number_of_merchandise_divisions_purchased",
    ),
    "life_stage_history": ("customer_guid", "lifestage_event", "lifestage_date"),
}
# Partition columns that a stored input may have besides.
PARTITIONS = {"sales_line": ("booked_month",)}


class RetailTables:
    """The inputs by name, each opened on first use and cut to the columns the jobs read."""

    def __init__(self, opener: Callable[[str], DataFrame]):
        self._opener = opener
        self._open: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in INPUTS:
            raise AttributeError(name)
        if name not in self._open:
            found = self._opener(name)
            pruning = [c for c in PARTITIONS.get(name, ()) if c in found.columns]
            self._open[name] = found.select(*INPUTS[name], *pruning)
        return self._open[name]

    @classmethod
    def from_database(cls, spark: SparkSession, database: str) -> "RetailTables":
        return cls(lambda name: spark.table(f"{database}.{name}"))

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str) -> "RetailTables":
        return cls(lambda name: spark.read.parquet(f"{folder}/{name}"))


def load_table(
    spark: SparkSession,
    table: str,
    limit: int | None = None,
    order_by: Sequence[str | Column] = (),
) -> DataFrame:
    """A table by name or Parquet path. A limit needs an order so that a rerun gives the same rows."""
    return limited(spark.read.parquet(table) if "/" in table else spark.table(table), limit, order_by)


def limited(df: DataFrame, limit: int | None, order_by: Sequence[str | Column]) -> DataFrame:
    """The first rows in an order that a rerun repeats; all rows without a limit."""
    if limit is None:
        return df
    if not order_by:
        raise ValueError("a limited read needs order_by")
    return df.orderBy(*order_by).limit(limit)


def run_query(spark: SparkSession, text: str, args: dict | None = None, **views: DataFrame) -> DataFrame:
    """A SQL text over tables and the given frames (named in the text as {name})."""
    return spark.sql(text, args=args, **views)


def feature_rows(df: DataFrame, features: Sequence[str], key: str = "customer_id") -> DataFrame:
    """Distinct key and feature rows to score."""
    return df.select(F.col(key), *features).distinct()
