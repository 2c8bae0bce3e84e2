"""Window stages moved to another day by signed deltas instead of a rerun.

A window of some months slides: the lines of the days behind the old end enter, those before the new start leave.
A distinct line holds its day, so the lines of a day are the same in every window that has the day, and the base
lines of the new window are the old ones without the days that leave, with the days that enter. Counts per
customer and SKU change by the difference of both; customer and type counts are their sums.

SKU pairs are a product of the counts with themselves. With A before, B after and D = B - A,
B x B - A x A = D x B + A x D, for the baskets that changed only. A basket also changes when its customer comes
into a region or leaves one.

Days whose lines were corrected or booked late are named as `restated`: what the state has of them leaves, what
the source has now enters. Products, customers and addresses are taken as they are now for the lines that enter;
customers whose region changed for other reasons than their purchases are passed along.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.expressions import month_window
from basketry.functions.lineage import staged
from basketry.operators import pairs, purchases
from basketry.sources.storage import month_number

ITEM = ("customer_id", "pdm_prod_type_id", "item_sku_num")


@dataclass(frozen=True)
class Move:
    """From the window up to `before` to the window up to `after`, not earlier, of so many months each."""

    before: dt.date
    after: dt.date
    months: int
    restated: tuple[dt.date, ...] = ()

    def __post_init__(self):
        if self.after < self.before:
            raise ValueError(f"a window moves forward: {self.before} to {self.after}")

    def _restated(self, date: Column) -> Column:
        return date.isin(*self.restated) if self.restated else F.lit(False)

    def entering(self, date: Column) -> Column:
        """Days of the new window that the old one lacks, or has otherwise."""
        new = date > F.lit(self.before)
        return month_window(date, self.after, self.months) & (new | self._restated(date) if self.restated else new)

    def entering_months(self) -> list[int]:
        """Months (YYYYMM) of the days that enter: those of the move, no more than the window's, and restated ones."""
        first, last = self.before + dt.timedelta(days=1), self.after
        span = range(max(first.year * 12 + first.month, last.year * 12 + last.month - self.months),
                     last.year * 12 + last.month + 1) if first <= last else ()
        months = {(m - 1) // 12 * 100 + (m - 1) % 12 + 1 for m in span}
        return sorted(months | {month_number(day) for day in self.restated})

    def leaving(self, date: Column) -> Column:
        """Days of the old window that the new one lacks, or has otherwise."""
        gone = date < F.add_months(F.lit(self.after).cast("date"), -self.months)
        return gone | self._restated(date) if self.restated else gone


@dataclass(frozen=True)
class WindowState:
    """Written stages of a window: base lines, counts per customer and SKU, regions of customers, SKU pairs."""

    base: DataFrame
    items: DataFrame
    regions: DataFrame
    pairs: DataFrame


def line_deltas(base: DataFrame, entering: DataFrame, move: Move) -> DataFrame:
    """Signed counts (customer, type, SKU, n) of the base lines that enter and leave; none that cancel out."""
    gone = base.filter(move.leaving(F.col("transaction_booked_date")))
    signed = entering.select(*ITEM, F.lit(1).alias("n")).union(gone.select(*ITEM, F.lit(-1).alias("n")))
    return signed.groupBy(*ITEM).agg(F.sum("n").alias("n")).filter("n <> 0")


def moved_base(base: DataFrame, entering: DataFrame, move: Move) -> DataFrame:
    """Base lines of the new window."""
    return base.filter(~move.leaving(F.col("transaction_booked_date"))).unionByName(entering)


def with_deltas(counts: DataFrame, deltas: DataFrame, value: str) -> DataFrame:
    """Additive counts with their signed changes; what comes to 0 is gone, below 0 the state is not the deltas' own."""
    keys = [c for c in counts.columns if c != value]
    total = F.sum(value)
    checked = F.when(total < 0, F.raise_error(F.lit(f"{value} below 0: the state has not what leaves"))).otherwise(total)
    summed = counts.unionByName(deltas.select(*counts.columns)).groupBy(*keys).agg(checked.alias(value))
    return summed.filter(F.col(value) != 0).select(*counts.columns)


def type_counts(items: DataFrame) -> DataFrame:
    """Purchase lines per customer and product type, from those per SKU."""
    return items.groupBy("customer_id", "pdm_prod_type_id").agg(F.sum("n").alias("trans_count"))


def pair_deltas(
    old: DataFrame, new: DataFrame, reference: DataFrame, by: Sequence[str] = ("region",),
    basket_key: str = "customer_id",
) -> DataFrame:
    """Signed changes (by, Focus, Recomm, count) of the SKU pairs when the counts (by, basket, type, SKU, n) of the
    changed baskets go from old to new."""
    keys = [*by, basket_key, "pdm_prod_type_id", "item_sku_num"]
    signed = new.select(*keys, "n").union(old.select(*keys, (-F.col("n")).alias("n")))
    delta = staged(signed.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0"), "item_deltas")
    types = pairs.reference_types(reference, by)
    added = pairs.pair_counts(delta, new, types, by, basket_key)
    taken = pairs.pair_counts(old, delta, types, by, basket_key)
    changed = added.union(taken).groupBy(*by, "Focus", "Recomm").agg(F.sum("count").alias("count"))
    return changed.filter(F.col("count") != 0)


def refresh_window(
    state: WindowState,
    entering: DataFrame,
    move: Move,
    reference: DataFrame,
    region_of: Callable[[DataFrame], DataFrame],
    min_types: int = 2,
    moved_customers: DataFrame | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = staged,
) -> WindowState:
    """The state of the new window.

    entering: base lines of the days that enter (move.entering). region_of gives (customer_id, region) of
    customers; it is asked for the changed ones. keep writes a stage and hands back the written table.
    """
    entering = staged(entering, "entering_lines")
    deltas = staged(line_deltas(state.base, entering, move), "line_deltas")
    items = keep(with_deltas(state.items, deltas, "n"), "basket_items")
    changed = deltas.select("customer_id")
    if moved_customers is not None:
        changed = changed.union(moved_customers.select("customer_id"))
    changed = staged(changed.distinct(), "changed_customers")
    new_items = staged(items.join(changed, "customer_id", "left_semi"), "changed_items")
    old_regions = state.regions.join(changed, "customer_id", "left_semi")
    new_regions = staged(region_of(purchases.multi_type_customers(type_counts(new_items), min_types)), "changed_regions")
    old = staged(state.items.join(old_regions, "customer_id"), "old_items")
    new = staged(new_items.join(new_regions, "customer_id"), "new_items")
    regions = state.regions.join(changed, "customer_id", "left_anti").unionByName(new_regions)
    return WindowState(
        keep(moved_base(state.base, entering, move), "base_transactions"),
        items,
        keep(regions, "region_of_customer"),
        keep(with_deltas(state.pairs, pair_deltas(old, new, reference), "count"), "sku_pairs"),
    )
