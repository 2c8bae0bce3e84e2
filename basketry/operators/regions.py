"""Sales region of customers by their preferred address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.expressions import region_of
from basketry.params import UNKNOWN_REGION, PairParams


def region_of_customer(
    customers: DataFrame,
    customer_address: DataFrame,
    address_mstr: DataFrame,
    mailing_address: DataFrame,
    params: PairParams,
) -> DataFrame:
    """Customer and region; a customer with preferred addresses in two regions has two rows.

    The chain starts from the customers asked for, so only their addresses are looked up.
    """
    preferred = customer_address.filter(F.col("prefd_cust_ind") == "Y").select("customer_id", "address_id")
    return (
        customers.select("customer_id")
        .join(preferred, "customer_id", "left")
        .join(address_mstr, "address_id", "left")
        .join(mailing_address, "mailing_address_id", "left")
        .select(
            "customer_id",
            region_of(F.col("territory_cd"), params.region_codes, UNKNOWN_REGION).alias("region"),
        )
        .distinct()
    )
