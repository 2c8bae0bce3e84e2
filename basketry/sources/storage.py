"""Sales stored for the jobs' joins: lines by month, lines and the customers of transactions in the same buckets.

Both tables are bucketed by transaction, so joining them moves no row; a window of days reads the folders of its
months only. `RetailTables.from_database` opens them like any other table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.sources.sinks import write_bucketed

MONTH = "booked_month"


def month_number(day: dt.date) -> int:
    """YYYYMM."""
    return day.year * 100 + day.month


def store_lines(lines: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Replace the table of sales lines: a folder per month (YYYYMM), buckets by transaction_guid."""
    month = F.date_format("transaction_booked_date", "yyyyMM").cast("int")
    return write_bucketed(lines.withColumn(MONTH, month), table, buckets, "transaction_guid", (MONTH,), path)


def store_owners(xref: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Replace the table of the transactions' customers: buckets by trans_id."""
    return write_bucketed(xref, table, buckets, "trans_id", path=path)


def owned_lines(lines: DataFrame, xref: DataFrame, months: DataFrame) -> DataFrame:
    """Stored lines of the given months (booked_month) with the customer of their transaction.

    The months are known only when the query runs: their distinct numbers, twelve a year, are broadcast and prune the
    folders before they are read.
    """
    wanted = lines.join(F.broadcast(months.select(MONTH).distinct()), MONTH, "left_semi")
    owners = xref.filter(F.col("customer_id") > 0).select(F.col("trans_id").alias("transaction_guid"), "customer_id")
    return wanted.join(owners, "transaction_guid")


def monthly_buyers(owned: DataFrame) -> DataFrame:
    """Lines, customers and units sold per month."""
    return owned.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("n_lines"), F.countDistinct("customer_id").alias("n_customers"),
        F.sum("sold_units").alias("units"),
    )
