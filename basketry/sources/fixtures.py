"""Inputs of the jobs derived from order-entry test tables.

The test data has customers, parts, orders and order lines; each input table is a view over them.
Odd rows (missing addresses, zero units, unknown types, double addresses) are planted by arithmetic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.reactivation import with_previous_date
from basketry.sources.tables import RetailTables

AS_OF = dt.date(2001, 8, 1)
EARLIEST_PREVIOUS = dt.date(1996, 1, 1)

# Columns read of the raw tables; naming them saves a look at every footer.
RAW = {
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}

# Kinds of part in type-id order; the last one is the catch-all.
PART_KINDS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL")
# Territory code planted for each nation key.
NATION_TERRITORY = (
    "OH", "IL", " mi ", "WI", "MN", "NY", "nj", "PA", "ME", "VT", "TX", "FL", "GA", " VA", "DC",
    "CA", "WA", "co", "AZ", "HI", "CT", "MA", "PR", None, "NC",
)


def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(RAW[name]).parquet(f"{folder}/{name}.parquet")


def retail_tables(spark: SparkSession, folder: str) -> RetailTables:
    views = _Views(spark, folder)
    return RetailTables(lambda name: getattr(views, name)())


class _Views:
    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder

    def _raw(self, name: str) -> DataFrame:
        return raw(self._spark, self._folder, name)

    def item_sku(self):
        kind = F.lit(len(PART_KINDS) + 1)
        for number, name in enumerate(PART_KINDS, start=1):
            kind = F.when(F.col("p_type") == name, number).otherwise(kind)
        brand = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("bigint")
        return self._raw("part").select(
            F.col("p_partkey").alias("item_sku_num"),
            F.when(F.col("p_size") == 50, 0).otherwise(brand * 10 + kind).cast("bigint")
            .alias("pdm_prod_type_id"),
            F.col("p_name").alias("item_sku_desc"),
            F.col("p_size").cast("bigint").alias("class_id"),
        )

    def pdm_prod_type(self):
        key = F.col("pdm_prod_type_id")
        return self.item_sku().select(key).distinct().select(
            key,
            F.when(key == 11, F.lit(None))
            .when((key % 10 == 6) & (key < 60), "UNKNOWN")
            .otherwise(F.concat(F.lit("TYPE "), key.cast("string")))
            .alias("pdm_prod_type_desc"),
        )

    def sku_levels(self):
        return self._raw("part").filter(F.col("p_partkey") % 97 != 0).select(
            F.col("p_partkey").alias("item_sku_num"),
            F.col("p_type").alias("l1"),
            F.col("p_brand").alias("l2"),
            F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("l3"),
            F.col("p_name").alias("l4"),
        )

    def class_code(self):
        size = F.col("p_size").cast("string")
        return self._raw("part").select(
            F.col("p_size").cast("bigint").alias("class_id"),
            F.concat(F.lit("C"), size).alias("class_cd"),
            F.concat(F.lit("Class "), size).alias("class_name"),
            (F.col("p_size") % 12).cast("bigint").alias("sub_department_id"),
        ).distinct()

    def sub_department(self):
        key = F.col("sub_department_id")
        return self.class_code().select(key).distinct().select(
            key,
            F.concat(F.lit("SD"), key.cast("string")).alias("sub_department_cd"),
            F.concat(F.lit("Sub "), key.cast("string")).alias("sub_department_name"),
            (key % 5).alias("department_id"),
        )

    def department(self):
        key = F.col("department_id")
        return self.sub_department().select(key).distinct().select(
            key,
            F.concat(F.lit("D"), key.cast("string")).alias("department_cd"),
            F.concat(F.lit("Dept "), key.cast("string")).alias("department_name"),
            F.concat(F.lit("IC"), (key % 2).cast("string")).alias("item_category_cd"),
        )

    def item_category(self):
        key = F.col("item_category_cd")
        return self.department().select(key).distinct().select(
            key, F.concat(F.lit("Category "), key).alias("item_category_desc")
        )

    def sales_line(self):
        orders = self._raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_orderdate").cast("date").alias("transaction_booked_date"),
        )
        no_units = (F.col("l_linenumber") == 7) & (F.col("l_quantity") == 1)
        return self._raw("lineitem").join(orders, "l_orderkey").select(
            F.col("l_orderkey").alias("transaction_guid"),
            F.col("l_partkey").alias("point_of_sale_item_sku_num"),
            "transaction_booked_date",
            F.col("l_extendedprice").alias("gross_sales"),
            F.when(no_units, 0.0).otherwise(F.col("l_quantity")).alias("sold_units"),
            F.when(F.col("l_returnflag") == "N", 2).otherwise(1).cast("bigint").alias("concept_format_id"),
        )

    def sales_txn(self):
        key = F.col("o_orderkey")
        return self._raw("orders").select(
            key.alias("transaction_guid"),
            F.col("o_orderdate").cast("date").alias("transaction_booked_date"),
            F.when(key % 50 != 49, F.col("o_totalprice")).alias("gross_sales"),
            F.when(F.col("o_orderstatus") == "F", "S").when(F.col("o_orderstatus") == "O", "M")
            .otherwise("R").alias("sales_transaction_type_code"),
            F.when(key % 10 == 9, 2).otherwise(1).cast("bigint").alias("concept_format_id"),
        )

    def customer_txn_xref(self):
        return self._raw("orders").select(
            F.col("o_orderkey").alias("trans_id"), F.col("o_custkey").alias("customer_id")
        )

    def customer_segments(self):
        key = F.col("o_orderkey")
        purchases = self._raw("orders").select(
            F.col("o_custkey").alias("customer_guid"),
            key.alias("transaction_guid"),
            F.col("o_orderdate").cast("date").alias("transaction_booked_date"),
            F.when(key % 10 == 9, 2).otherwise(1).cast("bigint").alias("concept_format_id"),
        )
        history = with_previous_date(
            purchases, "customer_guid", "transaction_booked_date", "transaction_guid", "previous"
        )
        gap = F.datediff("transaction_booked_date", "previous")
        return history.withColumn(
            "segment", F.when(gap.isNull(), "N").when(gap >= 365, "R").otherwise("A")
        )

    def customer_curr(self):
        key = F.col("c_custkey")
        return self._raw("customer").select(
            key.alias("customer_id"),
            F.when(F.col("c_acctbal") < 0, "Y").otherwise("N").alias("customer_purge_ind"),
            F.when(key % 17 == 0, 0).otherwise(key + 1000000).cast("bigint").alias("address_id"),
        )

    def customer_address(self):
        key = F.col("c_custkey")
        first = self._raw("customer").select(
            key.alias("customer_id"),
            (key + 1000000).alias("address_id"),
            F.when(key % 19 == 0, "N").otherwise("Y").alias("prefd_cust_ind"),
        )
        second = self._raw("customer").filter(key % 23 == 0).select(
            key.alias("customer_id"),
            ((key * 7) % 100 + 1000000).alias("address_id"),
            F.lit("Y").alias("prefd_cust_ind"),
        )
        return first.unionByName(second)

    def address_mstr(self):
        key = F.col("c_custkey")
        return self._raw("customer").filter(key % 29 != 0).select(
            (key + 1000000).alias("address_id"), (key + 2000000).alias("mailing_address_id")
        )

    def mailing_address(self):
        codes = F.array(*[F.lit(code) for code in NATION_TERRITORY])
        return self._raw("customer").select(
            (F.col("c_custkey") + 2000000).alias("mailing_address_id"),
            F.try_element_at(codes, F.col("c_nationkey") + 1).alias("territory_cd"),
        )

    def _address_period(self):
        # 7 years of months for every customer; about one month in eleven is missing.
        months = F.explode(F.sequence(F.lit(1995 * 12), F.lit(2001 * 12 + 11)))
        year, month = F.floor(F.col("m") / 12), F.col("m") % 12 + 1
        return (
            self._raw("customer").select(F.col("c_custkey").alias("k"), months.alias("m"))
            .filter((F.col("k") + month) % 11 != 0)
            .select(
                (F.col("k") + 1000000).alias("address_guid"),
                "k",
                (year * 100 + month).cast("int").alias("fiscal_period_id"),
                (F.col("m") + 1).cast("bigint").alias("n"),
            )
        )

    def address_demographics(self):
        k, n = F.col("k"), F.col("n")
        return self._address_period().select(
            "address_guid",
            "fiscal_period_id",
            ((k + n) % 2).cast("double").alias("A_A7478N_NEW_MOVER_YES"),
            F.when(k % 5 != 0, 800 + (k * 37) % 3200).cast("double").alias("A_A8588N_HM_SQR_FT"),
            ((k * 13) % 100).cast("double").alias("A_A3101N_RACE_WHITE"),
            F.when(k % 31 == 0, "n/a").otherwise(((k * 11) % 10).cast("string"))
            .alias("A_AAP000447N_ASET_PRPN_DIS_INC"),
        )

    def address_rfm(self):
        k, n = F.col("k"), F.col("n")
        return self._address_period().select(
            "address_guid",
            "fiscal_period_id",
            F.when((k + n) % 7 != 0, (k * 3 + n) % 730).cast("double").alias("beyond_recency_two_years"),
            F.when(k % 6 != 0, 1 + (k + n) % 10).cast("double")
            .alias("beyond_instore_monetary_decile_two_years"),
        )

    def address_promo(self):
        k, n = F.col("k"), F.col("n")
        return self._address_period().select(
            "address_guid",
            "fiscal_period_id",
            F.when(n % 9 != 0, (k + n * 5) % 365).cast("double").alias("PH_DM_RECENCY"),
            (((k * 7 + n) % 101).cast("double") / 100).alias("PH_MREDEEM730D_PERC"),
        )

    def address_seasonality(self):
        k, n = F.col("k"), F.col("n")
        return self._address_period().filter(k % 13 != 0).select(
            "address_guid",
            "fiscal_period_id",
            ((k * 17 + n) % 500).cast("double").alias("COUPON_SALES_Q_08"),
        )

    def shopping_metrics(self):
        k, n = F.col("k"), F.col("n")
        return self._address_period().select(
            "address_guid",
            "fiscal_period_id",
            (1 + (k + n) % 9).cast("double").alias("avg_items_per_transaction"),
            (((k * 19 + n * 3) % 2000).cast("double") / 10).alias("avg_net_sales_per_transaction"),
            (1 + k % 8).cast("bigint").alias("number_of_merchandise_divisions_purchased"),
        )

    def life_stage_history(self):
        key = F.col("c_custkey")
        start = F.lit(dt.date(1999, 6, 1))
        spread = (key * 37) % 800
        first = self._raw("customer").filter(key % 10 != 0).select(
            key.alias("customer_guid"),
            F.when(key % 4 == 0, "WEDDING").when(key % 4 == 1, "NEW MOVER").when(key % 4 == 2, "BABY")
            .otherwise("RETIREMENT").alias("lifestage_event"),
            F.date_add(start, spread.cast("int")).alias("lifestage_date"),
        )
        later = F.when(key % 6 == 0, spread).otherwise((key * 53) % 700)
        second = self._raw("customer").filter(key % 2 == 0).select(
            key.alias("customer_guid"),
            F.when(key % 3 == 0, "NEW MOVER").when(key % 3 == 1, "BABY").otherwise("WEDDING")
            .alias("lifestage_event"),
            F.date_add(start, later.cast("int")).alias("lifestage_date"),
        )
        return first.unionByName(second)


def shop_rows(events: DataFrame) -> DataFrame:
    """The test events as rows of shop events. The test table has no cart events; its clicks stand for them."""
    kinds = {"view": "view", "click": "cart_add", "purchase": "purchase"}
    named = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return events.select(
        "event_id", "ts", F.col("user_id").alias("customer_id"), named[F.col("event_type")].alias("kind"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("product_id"),
    )
