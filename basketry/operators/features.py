"""Features of customers at a date: address tables by fiscal period, and life-stage events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.functions.expressions import as_number, one_if
from basketry.functions.lineage import staged
from basketry.params import FEATURES, FILL_DEFAULT, FILL_RULES, LIFE_STAGE_DAYS, LIFE_STAGE_FLAGS
from basketry.sources.tables import RetailTables

KEYS = ("address_guid", "fiscal_period_id")

# Output name of each feature column, by input table.
DEMOGRAPHICS = {
    "A_A7478N_NEW_MOVER_YES": "A_A7478N_NEW_MOVER_YES",
    "A_A8588N_HM_SQR_FT": "A_A8588N_HM_SQR_FT",
    "A_A3101N_RACE_WHITE": "A_A3101N_RACE_WHITE",
    "A_AAP000447N_ASET_PRPN_DIS_INC": "A_AAP000447N_ASET_PRPN_DIS_INC",
}
RFM = {
    "beyond_recency_two_years": "BBB_R_2Y",
    "beyond_instore_monetary_decile_two_years": "BBB_INSTORE_M_DECILE_2Y",
}
PROMO = {"PH_DM_RECENCY": "PH_DM_RECENCY", "PH_MREDEEM730D_PERC": "PH_MREDEEM730D_PERC"}
SEASONALITY = {"COUPON_SALES_Q_08": "COUPON_SALES_Q_08"}
SHOPPING = {
    "avg_net_sales_per_transaction": "AVG_NET_SALES_PER_TXN",
    "avg_items_per_transaction": "AVG_TOTAL_ITEMS_PER_TXN",
    "number_of_merchandise_divisions_purchased": "NUM_MERCH_DIVISIONS",
}
# Table, columns, and the period of the training base it is read at: FP2 belongs to the purchase itself,
# FP to the one before.
LOOKUPS = (
    ("address_demographics", DEMOGRAPHICS, "FP2"),
    ("address_rfm", RFM, "FP"),
    ("address_promo", PROMO, "FP2"),
    ("address_seasonality", SEASONALITY, "FP"),
    ("shopping_metrics", SHOPPING, "FP"),
)

TRAINING_FEATURES = (
    "BBB_R_2Y", "BBB_INSTORE_M_DECILE_2Y", "A_A7478N_NEW_MOVER_YES", "A_A8588N_HM_SQR_FT",
    "A_A3101N_RACE_WHITE", "A_AAP000447N_ASET_PRPN_DIS_INC", "COUPON_SALES_Q_08", "PH_DM_RECENCY",
    "PH_MREDEEM730D_PERC", "AVG_NET_SALES_PER_TXN", "AVG_TOTAL_ITEMS_PER_TXN", "NUM_MERCH_DIVISIONS",
)


def _renamed(table: DataFrame, columns: dict[str, str], *keys: Column) -> DataFrame:
    return table.select(*keys, *[F.col(source).alias(name) for source, name in columns.items()])


def point_in_time_features(base: DataFrame, tables: RetailTables) -> DataFrame:
    """The base with its address features as known in the fiscal periods FP and FP2.

    Features are looked up once per distinct address and pair of periods. The keys are written first: their
    range of periods prunes the scans, and their known size lets the planner filter each feature table with
    them before it shuffles what is left.
    """
    lookup_key = ["address_id", "FP", "FP2"]
    wanted = staged(
        base.select(*lookup_key).filter(F.col("address_id").isNotNull()).distinct(), "lookup_keys"
    )
    periods = wanted.agg(*[f(p).alias(f"{n}_{p}") for p in ("FP", "FP2") for n, f in
                           (("low", F.min), ("high", F.max))]).first()
    found = wanted
    for name, columns, period in LOOKUPS:
        keys = wanted.select("address_id", period).distinct()
        inside = F.col("fiscal_period_id").between(
            F.lit(periods[f"low_{period}"]), F.lit(periods[f"high_{period}"])
        )
        rows = _renamed(
            getattr(tables, name).filter(inside), columns,
            F.col("address_guid").alias("address_id"), F.col("fiscal_period_id").alias(period),
        ).join(keys, ["address_id", period], "left_semi")
        found = found.join(rows, ["address_id", period], "left")
    # Feature tables with repeated keys multiply rows; equal ones count once.
    found = found.distinct()
    return base.join(found, lookup_key, "left").select(*base.columns, *TRAINING_FEATURES)


def latest_rows(table: DataFrame, addresses: DataFrame, last_period: int | None = None) -> DataFrame:
    """Rows of the last fiscal period of each wanted address, up to last_period if given; equal periods are all kept."""
    return latest_rows_of({"table": table}, addresses, last_period)["table"]


def latest_rows_of(
    tables: Mapping[str, DataFrame], addresses: DataFrame, last_period: int | None = None
) -> dict[str, DataFrame]:
    """The latest rows of each of the tables, by name.

    The tables are scanned twice and never sorted. The first scan, of the keys only, adds up to an address's last
    period in each task before the shuffle; these are written, for all tables in one job. Their periods, twelve a year,
    prune the second scan, whose rows stream past the addresses of their shuffle partition.
    """
    known = F.col("fiscal_period_id").isNotNull()
    if last_period is not None:
        known &= F.col("fiscal_period_id") <= last_period
    wanted = addresses.select(F.col("address_id").alias("address_guid"))
    keys = [table.filter(known).select(F.lit(n).alias("_table"), *KEYS) for n, table in enumerate(tables.values())]
    newest = staged(
        reduce(DataFrame.union, keys).groupBy("_table", "address_guid")
        .agg(F.max("fiscal_period_id").alias("fiscal_period_id")).join(wanted, "address_guid", "left_semi"),
        "newest_periods", ("_table",),
    )
    periods = [[] for _ in tables]
    for row in newest.select("_table", "fiscal_period_id").distinct().collect():
        periods[row["_table"]].append(row["fiscal_period_id"])
    return {
        name: table.filter(F.col("fiscal_period_id").isin(sorted(periods[n]))).join(
            newest.filter(F.col("_table") == n).drop("_table").hint("shuffle_hash"), list(KEYS), "left_semi"
        ).select(*table.columns).distinct()
        for n, (name, table) in enumerate(tables.items())
    }


def latest_features(addresses: DataFrame, tables: RetailTables, last_period: int | None = None) -> DataFrame:
    """Latest features of every wanted address, of any period up to last_period.

    Addresses and the rows of each table are made distinct before they are joined, so what is joined needs no look.
    """
    addresses = addresses.distinct()
    latest = latest_rows_of(
        {name: getattr(tables, name).select(*KEYS, *columns) for name, columns, _ in LOOKUPS}, addresses, last_period
    )
    found = addresses
    for name, columns, _ in LOOKUPS:
        rows = _renamed(latest[name], columns, F.col("address_guid").alias("address_id"))
        found = found.join(rows, "address_id", "left")
    return found


def latest_events(history: DataFrame, as_of=None) -> DataFrame:
    """Events of each customer's last event date.

    Reduced to one row per customer and event name first, so the window never holds more than the names.
    """
    if as_of is not None:
        history = history.filter(F.col("lifestage_date") <= F.lit(as_of))
    last = history.groupBy("customer_guid", "lifestage_event").agg(
        F.max("lifestage_date").alias("lifestage_date")
    )
    newest = F.max("lifestage_date").over(Window.partitionBy("customer_guid"))
    return last.withColumn("_newest", newest).filter(F.col("lifestage_date") == F.col("_newest")).drop("_newest")


def event_windows(events: DataFrame) -> DataFrame:
    """First and last day on which an event counts, and its flag column."""
    def pick(value) -> Column:
        items = list(LIFE_STAGE_DAYS.items())
        chain = F.when(F.col("lifestage_event") == items[0][0], value(items[0]))
        return reduce(lambda acc, i: acc.when(F.col("lifestage_event") == i[0], value(i)), items[1:], chain)

    date = F.col("lifestage_date")
    flags = [
        one_if(F.col("lifestage_event") == event).alias(flag) for event, flag in LIFE_STAGE_FLAGS.items()
    ]
    return events.select(
        F.col("customer_guid").alias("customer_id"),
        *flags,
        pick(lambda i: F.date_sub(date, i[1][0])).alias("start_date"),
        pick(lambda i: F.date_add(date, i[1][1])).alias("end_date"),
    )


def life_stage_flags(base: DataFrame, history: DataFrame, date: str, as_of=None) -> DataFrame:
    """Customer and date with 1 for each life-stage event that covers the date, else 0.

    Only a customer's latest event date counts, even if an older event still covers the date; with as_of, the
    latest one up to that day.
    """
    wanted = base.select("customer_id", date).distinct()
    windows = event_windows(
        latest_events(history.join(
            wanted.select(F.col("customer_id").alias("customer_guid")), "customer_guid", "left_semi"
        ), as_of)
    ).withColumnRenamed("customer_id", "_customer")
    covered = (F.col("customer_id") == F.col("_customer")) & F.col(date).between(
        F.col("start_date"), F.col("end_date")
    )
    flags = list(LIFE_STAGE_FLAGS.values())
    return wanted.join(windows, covered, "left").groupBy("customer_id", date).agg(
        *[F.coalesce(F.max(f), F.lit(0)).cast("bigint").alias(f) for f in flags]
    )


def reactivation_features(base: DataFrame, tables: RetailTables) -> DataFrame:
    """Training table: one row per customer, reactivation, type and feature row."""
    flags = life_stage_flags(base, tables.life_stage_history, "reactivation_purchase")
    return (
        point_in_time_features(base, tables)
        .join(flags, ["customer_id", "reactivation_purchase"])
        .select(*base.columns, *TRAINING_FEATURES, "MOVER")
    )


def period_of(day) -> int:
    """Fiscal period that holds a day."""
    return day.year * 100 + day.month


def scoring_features(listed: DataFrame, tables: RetailTables, as_of, known_only: bool = False) -> DataFrame:
    """Scoring table: listed customers with the latest features of their address, of all in the tables or of
    those known at as_of."""
    last_period, last_day = (period_of(as_of), as_of) if known_only else (None, None)
    addresses = listed.select("address_id").filter(F.col("address_id").isNotNull()).distinct()
    dated = listed.select("customer_id").withColumn("_today", F.lit(as_of).cast("date"))
    flags = life_stage_flags(dated, tables.life_stage_history, "_today", last_day).drop("_today")
    return (
        listed.join(latest_features(addresses, tables, last_period), "address_id", "left")
        .join(flags, "customer_id")
        .select(*listed.columns, *TRAINING_FEATURES, "MOVER")
        .distinct()
    )


def fill_value(feature: str, rules=FILL_RULES, default: float = FILL_DEFAULT) -> float:
    """Fill value of a feature: the first rule whose text is part of the name."""
    return next((value for part, value in rules if part in feature.upper()), default)


def impute_features(
    df: DataFrame, features: Sequence[str] = FEATURES, rules=FILL_RULES, default: float = FILL_DEFAULT
) -> DataFrame:
    """All features as doubles; nulls and values that are not numbers take the fill value."""
    filled = {
        name: F.coalesce(as_number(F.col(name)), F.lit(float(fill_value(name, rules, default))))
        for name in features
    }
    return df.withColumns(filled)
