"""Shop events: cleaning, sessions, abandoned carts, hourly profile, recommendations for the current product.

Functions take a streaming or a static frame of events, so a stream and its replay share one definition, but for
two: session_pairs sums over all closed sessions, of which a stream has no end (it writes session_pair_rows, to be
summed when read), and cart_recommendations needs a table of carts, which carts.py keeps up to date from a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from basketry.operators import pairs
from basketry.params import UNKNOWN_REGION

# The kinds of shop events; others are dropped.
KINDS = ("view", "click", "cart_add", "purchase")
# Sides of a session pair: what was bought, and what was seen or put in the cart.
BOUGHT, TOUCHED = 1, 2


def event_stream(
    spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100, glob: str | None = None,
    nested: bool = False,
) -> DataFrame:
    """New Parquet files of a folder (nested: and the folders in it) as a stream: all of them, or those whose names
    fit the glob."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if nested:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)


def shop_events(raw: DataFrame, late: str = "1 hour") -> DataFrame:
    """Shop events of rows (event_id, ts, customer_id, kind, product_id), each event id once.

    Duplicates are remembered as long as the watermark allows, so the state does not grow with the stream.
    """
    events = raw.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "customer_id", "kind", "product_id").filter(
        F.col("kind").isin(*KINDS) & F.col("product_id").isNotNull()
    )
    if raw.isStreaming:
        return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    return events.dropDuplicates(["event_id"])


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of a customer, closed by a pause of `gap`, with the distinct products of each kind.

    A session's set is bounded by the kinds and products there are, however long the session.
    """
    window = F.session_window("ts", gap).alias("w")
    return events.groupBy(window, "customer_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.collect_set(F.struct("kind", "product_id")).alias("seen"),
    ).select(
        "customer_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n_events", "seen"
    )


def session_pair_rows(closed: DataFrame) -> DataFrame:
    """(customer_id, start, bought, touched): each product bought in a session with each one seen or put in the cart.

    Both are taken from the session's own set, without a join, so a stream hands them out as sessions close.
    """
    def products(wanted) -> Column:
        return F.array_distinct(F.transform(F.filter("seen", wanted), lambda x: x["product_id"]))

    sides = closed.select(
        "customer_id", "start",
        F.explode(products(lambda x: x["kind"] == "purchase")).alias("bought"),
        products(lambda x: x["kind"] != "purchase").alias("touched"),
    )
    return sides.select("customer_id", "start", "bought", F.explode("touched").alias("touched"))


def count_session_pairs(rows: DataFrame) -> DataFrame:
    """Sessions of each pair, from the rows that a stream has written."""
    return rows.groupBy("bought", "touched").agg(F.count(F.lit(1)).alias("n_sessions"))


def session_pairs(closed: DataFrame) -> DataFrame:
    """Sessions in which one product was bought and the other one seen or put in the cart."""
    seen = closed.select("customer_id", "start", F.inline("seen"))
    history = seen.select(
        F.struct("customer_id", "start").alias("session"),
        F.when(F.col("kind") == "purchase", BOUGHT).otherwise(TOUCHED).alias("pdm_prod_type_id"),
        F.col("product_id").alias("item_sku_num"),
    )
    reference = closed.sparkSession.createDataFrame(
        [(BOUGHT, BOUGHT), (BOUGHT, TOUCHED)], "focus_pdm_prod_type_id int, recomm_pdm_prod_type_id int"
    )
    mined = pairs.sku_pairs(history, reference, basket_key="session", by=(), distinct_baskets=True)
    return mined.withColumnsRenamed({"Focus": "bought", "Recomm": "touched", "count": "n_sessions"})


def abandoned_carts(events: DataFrame, within: str = "24 hours") -> DataFrame:
    """Cart events with no purchase of the product by the customer in the time given.

    A stream keeps a cart event until the watermark of the events has passed its time to buy.
    """
    def side(kind: str, prefix: str) -> DataFrame:
        return events.filter(F.col("kind") == kind).select(
            F.col("event_id").alias(f"{prefix}_id"),
            F.col("customer_id").alias(f"{prefix}_customer"),
            F.col("product_id").alias(f"{prefix}_product"),
            F.col("ts").alias(f"{prefix}_ts"),
        )

    cart, sale = side("cart_add", "cart"), side("purchase", "sale")
    same = (
        (F.col("cart_customer") == F.col("sale_customer"))
        & (F.col("cart_product") == F.col("sale_product"))
        & (F.col("sale_ts") >= F.col("cart_ts"))
        & (F.col("sale_ts") <= F.col("cart_ts") + F.expr(f"INTERVAL {within}"))
    )
    return cart.join(sale, same, "left_outer").filter(F.col("sale_id").isNull()).select(
        F.col("cart_id").alias("event_id"),
        F.col("cart_customer").alias("customer_id"),
        F.col("cart_product").alias("product_id"),
        F.col("cart_ts").alias("ts"),
    )


def hourly_counts(events: DataFrame) -> DataFrame:
    """Events per kind and hour of the calendar."""
    return events.groupBy(F.window("ts", "1 hour").alias("w"), "kind").agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.col("w.start").alias("hour_start"), "kind", "n")


def hourly_profile(counts: DataFrame) -> DataFrame:
    """Events per kind, month and hour of the day, from hourly counts."""
    return counts.groupBy(
        "kind",
        F.month("hour_start").cast("bigint").alias("month"),
        F.hour("hour_start").cast("bigint").alias("hour"),
    ).agg(F.sum("n").alias("n"))


def live_recommendations(
    events: DataFrame, recs: DataFrame, customer_region: DataFrame, top_n: int | None = 10,
    default: str = UNKNOWN_REGION,
) -> DataFrame:
    """The best recommendations (None: all) for the product type of each event in the region of its customer, from the tables
    (region, ...) and (customer_id, region) of the last batch run.

    A customer in several regions gets the list of each, one in none that of the default region.
    """
    best = recs if top_n is None else recs.filter(F.col("rn") <= top_n)
    wanted = best.select(
        "region", F.col("focus_pdm_prod_type_id").alias("product_id"), "recomm_pdm_prod_type_id", "rn"
    )
    located = events.join(customer_region.select("customer_id", "region").distinct(), "customer_id", "left")
    return (
        located.withColumn("region", F.coalesce("region", F.lit(default)))
        .join(wanted, ["region", "product_id"])
        .select("event_id", "customer_id", "region", "product_id", "recomm_pdm_prod_type_id", "rn")
    )


def last_cart_events(events: DataFrame) -> DataFrame:
    """(customer_id, product_id, kind, ts, event_id): what last happened to a product of a customer's cart."""
    latest = F.max_by(F.struct("kind", "ts", "event_id"), F.struct("ts", "event_id")).alias("last")
    return (
        events.filter(F.col("kind").isin("cart_add", "purchase"))
        .groupBy("customer_id", "product_id").agg(latest).select("customer_id", "product_id", "last.*")
    )


def recommend_for_carts(
    cart: DataFrame, recs: DataFrame, customer_region: DataFrame, top_n: int = 10, default: str = UNKNOWN_REGION
) -> DataFrame:
    """The top_n types for every customer with a cart (customer_id, product_id): those best ranked for any type in
    it, without those that are in it.

    Types are reduced to one row per customer and type before they are ranked, so the ranks run over the types
    there are.
    """
    cart = cart.select("customer_id", "product_id")
    shown = live_recommendations(
        cart.withColumn("event_id", F.lit(0)), recs, customer_region, top_n=None, default=default
    )
    best = shown.groupBy("customer_id", F.col("recomm_pdm_prod_type_id").alias("product_id")).agg(
        F.min("rn").alias("best_rn"), F.count(F.lit(1)).alias("n_reasons")
    )
    order = Window.partitionBy("customer_id").orderBy("best_rn", F.desc("n_reasons"), "product_id")
    return (
        best.join(cart, ["customer_id", "product_id"], "left_anti")
        .withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top_n)
        .select("customer_id", F.col("product_id").alias("recomm_pdm_prod_type_id"), "best_rn", "n_reasons", "rank")
    )


def cart_recommendations(
    events: DataFrame, recs: DataFrame, customer_region: DataFrame, top_n: int = 10, default: str = UNKNOWN_REGION
) -> DataFrame:
    """recommend_for_carts for the carts at the end of a batch of events: what was put there and not bought since."""
    cart = last_cart_events(events).filter("kind = 'cart_add'")
    return recommend_for_carts(cart, recs, customer_region, top_n, default)


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table, all that has arrived so far; a restart goes on where it stopped."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
