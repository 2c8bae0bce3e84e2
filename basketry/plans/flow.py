"""The stages of all jobs over one set of inputs, each built from the ones before it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.lineage import staged
from basketry.operators import (
    catalog, features, pairs, purchases, ranking, ratings, reactivation, refresh, regions,
)
from basketry.params import PairParams, ReactivationParams
from basketry.sources.tables import RetailTables


class Flow:
    """Lazy stages. `keep` may write a stage that several later ones read, and hand back the written table.

    listed: customers (customer_id) to score instead of those at risk or lapsed. types: ids of the product types
    to model instead of the most frequent ones.
    """

    def __init__(
        self,
        tables: RetailTables,
        pair_params: PairParams,
        reactivation_params: ReactivationParams,
        keep=lambda df, name: df,
        listed: DataFrame | None = None,
        types: Sequence[int] | None = None,
    ):
        self._listed, self._types = listed, types
        self.tables = tables
        self.pairs = pair_params
        self.returns = reactivation_params
        self._keep = keep

    # Products

    @cached_property
    def sku_dimension(self) -> DataFrame:
        t = self.tables
        return self._keep(
            catalog.sku_dimension(t.item_sku, t.pdm_prod_type, t.sku_levels), "sku_dimension"
        )

    @cached_property
    def catalog_rows(self) -> DataFrame:
        t = self.tables
        rows = catalog.catalog_rows(
            t.item_sku, t.pdm_prod_type, t.sku_levels, t.class_code, t.sub_department, t.department,
            t.item_category,
        )
        return self._keep(rows, "catalog_rows")

    @cached_property
    def sku_catalog(self) -> DataFrame:
        return self._keep(catalog.sku_catalog(self.catalog_rows), "sku_catalog")

    # Type pairs

    @cached_property
    def base_transactions(self) -> DataFrame:
        t = self.tables
        rows = purchases.base_transactions(
            t.sales_line, t.customer_txn_xref, t.customer_curr, self.sku_dimension, self.pairs
        )
        return self._keep(rows, "base_transactions")

    @cached_property
    def customer_type_counts(self) -> DataFrame:
        return self._keep(purchases.customer_type_counts(self.base_transactions), "customer_type_counts")

    @cached_property
    def multi_type_customers(self) -> DataFrame:
        return purchases.multi_type_customers(self.customer_type_counts, self.pairs.min_types)

    @cached_property
    def region_of_customer(self) -> DataFrame:
        t = self.tables
        rows = regions.region_of_customer(
            self.multi_type_customers, t.customer_address, t.address_mstr, t.mailing_address, self.pairs
        )
        return self._keep(rows, "region_of_customer")

    @cached_property
    def surrogate_ids(self) -> DataFrame:
        return ratings.surrogate_ids(self.customer_type_counts)

    @cached_property
    def item_seed_rows(self) -> DataFrame:
        return ratings.item_seed_rows(self.surrogate_ids)

    @cached_property
    def regional_ratings(self) -> DataFrame:
        rows = ratings.regional_ratings(
            self.customer_type_counts, self.region_of_customer, self.item_seed_rows, self.pairs.regions
        )
        return self._keep(rows, "regional_ratings")

    def recommendations(self, scores: DataFrame) -> DataFrame:
        """Ranked type recommendations from scores of the seed customers."""
        return ranking.recommend_types(
            ranking.rank_candidates(scores), self.item_seed_rows, self.tables.pdm_prod_type,
            self.pairs.rank_limit,
        )

    # SKU pairs

    @cached_property
    def regional_history(self) -> DataFrame:
        return pairs.tag_regions(self.base_transactions, self.region_of_customer)

    def refreshed(self, state: refresh.WindowState, before: dt.date, reference: DataFrame,
                  restated: Sequence[dt.date] = (), moved_customers: DataFrame | None = None) -> refresh.WindowState:
        """The window of an earlier day's run moved to this run's day by deltas, for the same type pairs."""
        t, p = self.tables, self.pairs
        move = refresh.Move(before, p.as_of, p.window_months, tuple(restated))
        entering = purchases.base_transactions(
            t.sales_line, t.customer_txn_xref, t.customer_curr, self.sku_dimension, p, move.entering,
            move.entering_months(),
        )
        return refresh.refresh_window(
            state, entering, move, reference,
            lambda customers: regions.region_of_customer(
                customers, t.customer_address, t.address_mstr, t.mailing_address, p
            ),
            p.min_types, moved_customers,
            lambda df, name: kept if (kept := self._keep(df, name)) is not df else staged(df, name),
        )

    # Reactivation, training side

    @cached_property
    def known_skus(self) -> DataFrame:
        """SKU, type and descriptions of the catalog."""
        return catalog.catalog_skus(self.catalog_rows)

    @cached_property
    def reactivated_purchases(self) -> DataFrame:
        t = self.tables
        rows = reactivation.reactivated_purchases(
            t.customer_segments, t.sales_line, self.known_skus, t.customer_curr, self.returns
        )
        return self._keep(rows, "reactivated_purchases")

    @cached_property
    def purchase_gaps(self) -> DataFrame:
        t = self.tables
        return reactivation.purchase_gaps(
            t.sales_txn, t.customer_txn_xref, self.reactivated_purchases, self.returns
        )

    @cached_property
    def top_reactivation_types(self) -> DataFrame:
        return reactivation.top_reactivation_types(
            self.reactivated_purchases, self.returns.top_types, keep_null=self.returns.keep_null_type
        )

    def shopping_types(self, skip: int = 1) -> list[int]:
        """Ids of the types to model: those given, or at most `top_types`, without the first `skip` and null."""
        if self._types is not None:
            return sorted(set(self._types))
        rows = reactivation.top_reactivation_types(
            self.reactivated_purchases, self.returns.top_types, skip, self.returns.keep_null_type
        )
        return sorted(
            r["pdm_prod_type_id"] for r in rows.collect() if r["pdm_prod_type_id"] is not None
        )

    @cached_property
    def reactivation_base(self) -> DataFrame:
        rows = reactivation.reactivation_base(self.reactivated_purchases, self.purchase_gaps, self.returns)
        return self._keep(rows, "reactivation_base")

    @cached_property
    def point_in_time_features(self) -> DataFrame:
        return features.point_in_time_features(self.reactivation_base, self.tables)

    @cached_property
    def life_stage_flags(self) -> DataFrame:
        return features.life_stage_flags(
            self.reactivation_base, self.tables.life_stage_history, "reactivation_purchase"
        )

    @cached_property
    def reactivation_features(self) -> DataFrame:
        return self._keep(
            features.reactivation_features(self.reactivation_base, self.tables), "reactivation_features"
        )

    # Reactivation, scoring side

    @cached_property
    def at_risk_lapsed(self) -> DataFrame:
        t = self.tables
        return reactivation.at_risk_lapsed(t.sales_txn, t.customer_txn_xref, self.returns)

    @cached_property
    def scoring_customers(self) -> DataFrame:
        t = self.tables
        listed = self.at_risk_lapsed if self._listed is None else self._listed
        rows = reactivation.scoring_customers(
            t.sales_txn, t.customer_txn_xref, listed, t.customer_curr, self.returns
        )
        return self._keep(rows, "scoring_customers")

    @cached_property
    def latest_features(self) -> DataFrame:
        addresses = self.scoring_customers.select("address_id").filter(
            F.col("address_id").isNotNull()
        ).distinct()
        until = features.period_of(self.returns.as_of) if self.returns.known_only else None
        return features.latest_features(addresses, self.tables, until)

    @cached_property
    def scoring_features(self) -> DataFrame:
        return self._keep(
            features.scoring_features(
                self.scoring_customers, self.tables, self.returns.as_of, self.returns.known_only
            ),
            "scoring_features",
        )
