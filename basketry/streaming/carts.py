"""Customers' carts as a table that a stream keeps up to date.

Each micro-batch is reduced to what last happened to a product of a customer's cart and written below its batch
id, so a batch that is delivered again overwrites itself or, once it is complete, is left alone. The cart is the
latest event of customer and product over all batches; an entry expires when nothing has happened to it for `keep`
before the newest event. Compaction folds the batches into one base and lets expired entries go.

The latest event does not depend on the order of batches, so late events change what they should and nothing else.
A customer with a third of all events is one row per product and batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.functions.lineage import complete_folders
from basketry.streaming.events import last_cart_events

EVENT = "customer_id bigint, product_id bigint, kind string, ts timestamp, event_id bigint"


class CartTable:
    """Carts in a folder all executors reach. keep: how long an entry counts, None for ever."""

    def __init__(self, spark: SparkSession, path: str, keep: str | None = "30 days"):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def _numbered(self, kind: str) -> dict[int, str]:
        """Complete folders by their number."""
        return {int(f.rpartition("-")[2]): f for f in complete_folders(self.spark, f"{self.path}/{kind}-*")}

    def _folded(self) -> int:
        """The last batch that the base has."""
        return max(self._numbered("base"), default=-1)

    def upsert(self, events: DataFrame, batch_id: int) -> bool:
        """Take in a batch of events; False if it is there already, and then nothing changes."""
        if batch_id <= self._folded() or batch_id in self._numbered("batch"):
            return False
        columns = [f"cast({c} as {t}) as {c}" for c, t in (x.split() for x in EVENT.split(", "))]
        last_cart_events(events).selectExpr(*columns).write.mode("overwrite").parquet(f"{self.path}/batch-{batch_id}")
        return True

    def last_events(self) -> DataFrame:
        """The latest event of every customer and product that has not expired."""
        base, folded = self._numbered("base"), self._folded()
        folders = [f for n, f in self._numbered("batch").items() if n > folded]
        if folded >= 0:
            folders.append(base[folded])
        if not folders:
            return self.spark.createDataFrame([], EVENT)
        rows = self.spark.read.schema(EVENT).parquet(*folders)
        latest = last_cart_events(rows)
        if self.keep is None:
            return latest
        newest = rows.agg(F.max("ts")).first()[0]
        return latest.filter(F.col("ts") >= F.lit(newest) - F.expr(f"INTERVAL {self.keep}"))

    def carts(self) -> DataFrame:
        """(customer_id, product_id, ts) of what is in the carts: put there and not bought since."""
        return self.last_events().filter("kind = 'cart_add'").select("customer_id", "product_id", "ts")

    def compact(self) -> None:
        """Fold all batches into a base. Readers take the newest complete base, so an interrupted one is not seen."""
        newest = max(self._numbered("batch"), default=-1)
        if newest > self._folded():
            self.last_events().write.mode("overwrite").parquet(f"{self.path}/base-{newest}")


def keep_carts(events: DataFrame, table: CartTable, checkpoint: str) -> StreamingQuery:
    """Take a stream of shop events into the table, all that has arrived so far; a restart goes on where it stopped."""
    return (
        events.writeStream.foreachBatch(lambda batch, batch_id: table.upsert(batch, batch_id) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
