"""The registered queries: each a stage or report over the test tables' folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, TimestampType

from basketry.functions.lineage import fresh_path, staged
from basketry.operators import (
    boosting, calibration, catalog, diversity, factorization, features, monitoring, pairs, propensity, purchases,
    ranking, refresh, segments,
)
from basketry.params import FEATURES, ClusterParams, FactorParams, PairParams, ReactivationParams, TreeParams
from basketry.plans.checked_scores import co_purchase_scores, purchase_shares
from basketry.plans.flow import Flow
from basketry.session import tuned
from basketry.sources import sinks, storage
from basketry.sources.tables import RetailTables
from basketry.sources.fixtures import AS_OF, EARLIEST_PREVIOUS, RAW, raw, retail_tables, shop_rows
from basketry.streaming import carts
from basketry.streaming import events as streams

# Stages that several later ones read; they are written once per query.
SHARED_STAGES = frozenset((
    "customer_type_counts", "region_of_customer", "regional_ratings", "reactivated_purchases",
    "reactivation_base", "scoring_customers",
))
# Queries that read the purchase lines twice.
LINE_QUERIES = frozenset((
    "sku_pairs", "sku_pairs_by_transaction", "sku_pair_customers", "sku_recommendations", "mined_type_reference",
))
# Small models for the checks; the library's defaults are those of a full training run.
CHECK_TREES = TreeParams(trees=2, max_depth=3, calibration="none", parallelism=16)
CHECK_BOOST = boosting.BoostParams(trees=2, max_depth=3)
CHECK_FACTORS = FactorParams()
# Every id the test tables can give a type: brand 1-25 and kind 1-6.
ALL_TYPES = tuple(brand * 10 + kind for brand in range(1, 26) for kind in range(1, 7))
# Cents divided by whole units can end in a five at the seventh digit, where engines round differently.
DIGITS = {"base_transactions": 8, "refreshed_base_transactions": 8, "stored_base_transactions": 8}
LOOKUP = {"product_id": 21, "region": "Midwest", "top_n": 5}
CENTRES = 3
CLUSTERS_TRIED = (2, 3, 4, 5)
# Buckets of the stored sales, and the months of the year whose sales one query asks for.
BUCKETS, SEASON = 4, (11, 12)
REPLICATES = 100
# Sketches of this size hold the groups of the smaller test tables exactly.
SKETCH, QUANTILES = 4096, (0.05, 0.25, 0.5, 0.75, 0.95)
# A day in the middle of the tables, for runs that must not see what comes after it.
PAST = dt.date(1999, 8, 1)
# Six months and a day later: the window of six months up to it begins the day after PAST.
LATER = dt.date(2000, 2, 2)
# Two weeks after PAST: the day a run of PAST is moved to by deltas.
REFRESHED = dt.date(1999, 8, 15)
PAST_STAGES = ("purchase_gaps", "at_risk_lapsed", "scoring_customers", "latest_features", "scoring_features")
# The test events are hours apart, so sessions and carts get longer pauses than in a shop.
SESSION_GAP = "8 hours"
# How long the streams wait for late events, and in how many parts the test events arrive.
LATE, ARRIVALS = "1 hour", 3
CART_WAIT = "240 hours"


def flow(spark: SparkSession, folder: str, last: str = "", as_of: dt.date = AS_OF) -> Flow:
    """Stages over the folder; shared ones are written, except the one the query itself returns.

    A run for today takes the tables as they are, one for an earlier day what was known then.
    """
    def keep(df: DataFrame, name: str) -> DataFrame:
        shared = name in SHARED_STAGES or (name == "base_transactions" and last in LINE_QUERIES)
        return staged(df, name) if shared and name != last else df

    return Flow(
        retail_tables(spark, folder),
        PairParams(as_of),
        ReactivationParams(as_of, earliest_previous=EARLIEST_PREVIOUS, known_only=as_of < AS_OF),
        keep,
    )


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates and arrays as text and doubles rounded, so that rows compare by value."""
    def shown(field) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DoubleType):
            column = F.round(column, digits)
        elif isinstance(field.dataType, DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def _scores(f: Flow) -> DataFrame:
    return co_purchase_scores(f.regional_ratings, f.surrogate_ids)


def _shares(f: Flow) -> DataFrame:
    return purchase_shares(f.customer_type_counts)


def _recs(f: Flow) -> DataFrame:
    return f.recommendations(_scores(f))


def _candidates(f: Flow) -> DataFrame:
    return ranking.flatten_candidates(ranking.candidate_lists(_scores(f)))


def _candidate_lists(f: Flow) -> DataFrame:
    return ranking.candidate_lists(_scores(f)).select(
        "region", "customer_id", F.col("recommended.pdm_prod_type_id").alias("recommended_types")
    )


def _reference(f: Flow) -> DataFrame:
    return ranking.type_pair_reference(_recs(f), f.pairs.reference_ranks)


def _kept_reference(f: Flow) -> DataFrame:
    return staged(_reference(f), "type_pair_reference")


def _sku_pairs(f: Flow) -> DataFrame:
    return pairs.sku_pairs(f.regional_history, _reference(f))


def _sku_pairs_by_transaction(f: Flow) -> DataFrame:
    return pairs.sku_pairs(f.regional_history, _reference(f), basket_key="transaction_guid")


def _sku_pair_customers(f: Flow) -> DataFrame:
    return pairs.sku_pairs(f.regional_history, _reference(f), distinct_baskets=True)


def _sku_recommendations(f: Flow) -> DataFrame:
    reference = _kept_reference(f)
    mined = pairs.sku_pairs(f.regional_history, reference)
    return pairs.sku_recommendations(mined, f.sku_dimension, reference)


def _mined_reference(f: Flow) -> DataFrame:
    described = staged(_sku_recommendations(f), "sku_recommendations")
    return ranking.type_pair_reference(described, f.pairs.reference_ranks)


def _als_scores(f: Flow) -> DataFrame:
    indexed = factorization.indexed_ratings(f.regional_ratings, f.surrogate_ids)
    models = factorization.fit_regional_als(indexed, f.pairs.regions, CHECK_FACTORS)
    return factorization.seed_scores(models, indexed, f.pairs.rank_limit)


def _als_recs(f: Flow) -> DataFrame:
    return f.recommendations(staged(_als_scores(f), "als_scores"))


def _imputed(f: Flow) -> DataFrame:
    return features.impute_features(f.scoring_features).select("customer_id", *FEATURES)


def _trained(f: Flow) -> tuple[dict, str]:
    folder = fresh_path(f.tables.sales_txn.sparkSession, "models")
    training = staged(f.reactivation_features, "reactivation_features")
    return propensity.train_propensity(training, f.shopping_types(), folder, CHECK_TREES), folder


def _manifest(f: Flow) -> DataFrame:
    _, folder = _trained(f)
    return propensity.read_manifest(f.tables.sales_txn.sparkSession, folder)


def _propensity(f: Flow) -> DataFrame:
    models, _ = _trained(f)
    return propensity.propensity_scores(f.scoring_features, models)


def _boosted(f: Flow) -> DataFrame:
    """Trees of all shopping types, of the sampled training rows."""
    training = staged(f.reactivation_features, "reactivation_features")
    sampled = propensity.sample_rows(training, CHECK_TREES.train_share, CHECK_TREES.seed)
    folder = fresh_path(training.sparkSession, "boosted")
    return boosting.train_boosted(sampled, f.shopping_types(), folder, CHECK_BOOST)


def _boosted_scores(f: Flow) -> DataFrame:
    return boosting.boosted_scores(f.scoring_features, _boosted(f))


def _importance(f: Flow) -> DataFrame:
    models, _ = _trained(f)
    return propensity.feature_importance(models, f.tables.sales_txn.sparkSession)


def _bought_again(f: Flow) -> DataFrame:
    """Customer-and-type shares, with an outcome to calibrate to: the type was bought again."""
    return f.customer_type_counts.join(
        _shares(f), ["customer_id", "pdm_prod_type_id"]
    ).select(
        "customer_id",
        # One curve per price class of types, the last digit of the id.
        (F.col("pdm_prod_type_id") % 10).alias("pdm_prod_type_id"),
        "p",
        (F.col("trans_count") > 1).cast("double").alias("y"),
    )


def _binned(f: Flow) -> DataFrame:
    """The shares in tenths."""
    return _bought_again(f).withColumn("p", F.floor(F.col("p") * 10) / 10)


def _calibrated(f: Flow) -> DataFrame:
    binned = _binned(f)
    return _fitted_points(binned)


def _fitted_points(scored: DataFrame) -> DataFrame:
    curves = staged(calibration.fit_calibration(scored), "calibration-curves")
    points = scored.groupBy("pdm_prod_type_id", "p").agg(F.count(F.lit(1)).alias("n"))
    return calibration.calibrate_scores(points, curves)


def _calibrated_unbinned(f: Flow) -> DataFrame:
    return _fitted_points(staged(_bought_again(f), "shares"))


def _score_checkpoint(f: Flow) -> DataFrame:
    """A run that finished all types, then a rerun whose other values must not replace them."""
    scores = _shares(f)
    path = fresh_path(scores.sparkSession, "scores")
    sinks.checkpoint_scores(scores, path)
    return sinks.checkpoint_scores(scores.withColumn("p", -F.col("p")), path)


def _write_table(f: Flow) -> DataFrame:
    """Replace twice, append once: every count is there two times."""
    counts = f.customer_type_counts
    path = fresh_path(counts.sparkSession, "table")
    sinks.write_table(counts, path, "replace")
    sinks.write_table(counts, path, "replace", sort_by=["customer_id"])
    return sinks.write_table(counts, path, "append")


def _wide(f: Flow) -> DataFrame:
    return segments.pivot_scores(_shares(f), ALL_TYPES)


def _filled(f: Flow) -> DataFrame:
    return _wide(f).na.fill(0.0)


def _centres(wide: DataFrame) -> list[list[float]]:
    """Mean vector of the customers whose id leaves 0, 1 and 2 when divided by 3."""
    columns = [c for c in wide.columns if c != "customer_id"]
    group = F.pmod("customer_id", F.lit(CENTRES)).alias("g")
    means = wide.groupBy(group).agg(*[F.round(F.avg(c), 6).alias(c) for c in columns])
    return [[row[c] for c in columns] for row in sorted(means.collect(), key=lambda r: r["g"])]


def _nearest(f: Flow) -> DataFrame:
    wide = staged(_filled(f), "wide")
    columns = [c for c in wide.columns if c != "customer_id"]
    return segments.nearest_centroid(wide, _centres(wide), columns).select("customer_id", "CENTROID_ID")


def _clusters(f: Flow) -> DataFrame:
    wide = staged(_filled(f), "wide")
    return segments.assign_clusters(wide, segments.fit_clusters(wide, ClusterParams()))


def _choices(f: Flow) -> DataFrame:
    wide = staged(_filled(f), "wide")
    params = ClusterParams(candidates=CLUSTERS_TRIED, starts=1)
    choices = segments.cluster_choices(wide, params.candidates, params)
    best = segments.best_choice(choices)
    rows = [(clusters, silhouette, (clusters, seed) == best) for clusters, seed, silhouette in choices]
    return wide.sparkSession.createDataFrame(rows, "clusters bigint, silhouette double, chosen boolean")


def _drift(f: Flow) -> DataFrame:
    before = features.impute_features(f.reactivation_features)
    after = features.impute_features(f.scoring_features)
    return monitoring.feature_drift(before, after, FEATURES, (1, 5, 10, 50, 100, 300, 700))


def _hits(f: Flow) -> DataFrame:
    return monitoring.pair_hits(staged(_recs(f), "recs"), f.customer_type_counts, f.region_of_customer)


def _quantiles(f: Flow) -> DataFrame:
    """Quantiles per price class of types, from sketches kept by day (the customer's id by seven) and merged."""
    classes = _shares(f).select(
        (F.col("pdm_prod_type_id") % 10).alias("pdm_prod_type_id"), F.pmod("customer_id", F.lit(7)).alias("day"), "p"
    )
    daily = staged(monitoring.score_sketches(classes, ["pdm_prod_type_id", "day"], SKETCH), "sketches")
    return monitoring.sketch_quantiles(monitoring.merged_sketches(daily), QUANTILES)


STAGES: dict[str, Callable[[Flow], DataFrame]] = {
    "sku_catalog": lambda f: f.sku_catalog,
    "types_per_level": lambda f: catalog.types_per_level(f.catalog_rows),
    "sku_dimension": lambda f: f.sku_dimension,
    "base_transactions": lambda f: f.base_transactions,
    "customer_type_counts": lambda f: f.customer_type_counts,
    "multi_type_customers": lambda f: f.multi_type_customers,
    "region_of_customer": lambda f: f.region_of_customer,
    "surrogate_ids": lambda f: f.surrogate_ids,
    "item_seed_rows": lambda f: f.item_seed_rows,
    "regional_ratings": lambda f: f.regional_ratings,
    "supported_types": lambda f: purchases.supported_types(f.customer_type_counts, 3),
    "supported_ratings": lambda f: purchases.supported_ratings(f.regional_ratings, f.customer_type_counts, 10),
    "regional_als": _als_scores,
    "candidate_lists": _candidate_lists,
    "ranked_candidates": _candidates,
    "recommend_types": _recs,
    "recommend_types_als": _als_recs,
    "get_recommendations": lambda f: ranking.get_recommendations(_recs(f), **LOOKUP),
    "type_pair_reference": _reference,
    "mined_type_reference": _mined_reference,
    "sku_pairs": _sku_pairs,
    "sku_pairs_by_transaction": _sku_pairs_by_transaction,
    "sku_pair_customers": _sku_pair_customers,
    "sku_recommendations": _sku_recommendations,
    "reactivated_purchases": lambda f: f.reactivated_purchases,
    "purchase_gaps": lambda f: f.purchase_gaps,
    "top_reactivation_types": lambda f: f.top_reactivation_types,
    "reactivation_base": lambda f: f.reactivation_base,
    "point_in_time_features": lambda f: f.point_in_time_features,
    "life_stage_flags": lambda f: f.life_stage_flags,
    "reactivation_features": lambda f: f.reactivation_features,
    "at_risk_lapsed": lambda f: f.at_risk_lapsed,
    "scoring_customers": lambda f: f.scoring_customers,
    "latest_features": lambda f: f.latest_features,
    "scoring_features": lambda f: f.scoring_features,
    "impute_features": _imputed,
    "train_propensity": _manifest,
    "propensity_scores": _propensity,
    "boosted_trees": _boosted,
    "boosted_scores": _boosted_scores,
    "calibrate_scores": _calibrated,
    "calibrate_unbinned_scores": _calibrated_unbinned,
    "score_checkpoint": _score_checkpoint,
    "write_table": _write_table,
    "pivot_scores": _wide,
    "top_types_per_customer": lambda f: segments.top_types_per_customer(_shares(f)),
    "nearest_centroid": _nearest,
    "cluster_customers": _clusters,
    "cluster_choices": _choices,
    "cluster_sizes": lambda f: monitoring.cluster_sizes(_nearest(f)),
    "score_quantiles": _quantiles,
    "score_distribution": lambda f: monitoring.score_distribution(_shares(f)),
    "calibration_curve": lambda f: calibration.calibration_curve(_binned(f)),
    "feature_drift": _drift,
    "feature_importance": _importance,
    "coverage": lambda f: monitoring.coverage(_recs(f), f.sku_dimension),
    "region_diversity": lambda f: diversity.region_diversity(staged(_recs(f), "recs"), f.sku_dimension),
    "type_paths": lambda f: diversity.type_paths(f.sku_dimension),
    "pair_hits": _hits,
    "bootstrap_difference": lambda f: monitoring.bootstrap_difference(
        f.base_transactions.withColumn("arm", F.pmod("customer_id", F.lit(2))), "arm", "sku_price", (0, 1),
        replicates=REPLICATES,
    ),
    "compare_groups": lambda f: monitoring.compare_groups(
        f.base_transactions.withColumn("arm", F.pmod("customer_id", F.lit(2))), "arm", "sku_price"
    ),
}


def _later_hits(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of the window up to PAST against purchases of the window after it."""
    recs = staged(_recs(flow(spark, folder, as_of=PAST)), "recs")
    later = flow(spark, folder, as_of=LATER)
    return monitoring.later_hits(recs, later.customer_type_counts, later.region_of_customer)


@contextmanager
def stored_sales(spark: SparkSession, folder: str) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Sales lines and the customers of transactions as bucketed tables, which leave the catalog afterwards."""
    tables, run = retail_tables(spark, folder), uuid.uuid4().hex
    names = [f"{name}_{run}" for name in ("sales_line", "customer_txn_xref")]
    try:
        yield (
            storage.store_lines(tables.sales_line, names[0], BUCKETS, fresh_path(spark, names[0])),
            storage.store_owners(tables.customer_txn_xref, names[1], BUCKETS, fresh_path(spark, names[1])),
        )
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def stored_base(spark: SparkSession, folder: str, lines: DataFrame, xref: DataFrame) -> DataFrame:
    """Purchases of the window from stored sales."""
    others = retail_tables(spark, folder)
    stored = {"sales_line": lines, "customer_txn_xref": xref}
    tables = RetailTables(lambda name: stored[name] if name in stored else getattr(others, name))
    return Flow(tables, PairParams(AS_OF), ReactivationParams(AS_OF)).base_transactions


def _stored_base(spark: SparkSession, folder: str) -> DataFrame:
    with stored_sales(spark, folder) as (lines, xref):
        return staged(stored_base(spark, folder, lines, xref), "stored_base")


def season_months(lines: DataFrame) -> DataFrame:
    """The season's months that have sales, from the calendar of stored months."""
    calendar = staged(lines.select(storage.MONTH).distinct(), "calendar")
    return calendar.filter((F.col(storage.MONTH) % 100).isin(*SEASON))


def _seasonal(spark: SparkSession, folder: str) -> DataFrame:
    with stored_sales(spark, folder) as (lines, xref):
        owned = storage.owned_lines(lines, xref, season_months(lines))
        return staged(storage.monthly_buyers(owned), "seasonal")


def window_state(spark: SparkSession, folder: str, day: dt.date) -> tuple[refresh.WindowState, DataFrame]:
    """Written stages of a day's run, and its type pairs."""
    f = flow(spark, folder, as_of=day)
    base = staged(f.base_transactions, "base_transactions")
    reference = _kept_reference(f)
    mined = pairs.sku_pairs(pairs.tag_regions(base, f.region_of_customer), reference)
    state = refresh.WindowState(
        base, staged(pairs.basket_items(base), "basket_items"), f.region_of_customer, staged(mined, "sku_pairs")
    )
    return state, reference


def _refreshed(spark: SparkSession, folder: str) -> refresh.WindowState:
    """The run of PAST moved to REFRESHED."""
    state, reference = window_state(spark, folder, PAST)
    return flow(spark, folder, as_of=REFRESHED).refreshed(state, PAST, reference)


def _arrivals(spark: SparkSession, folder: str):
    """The test events in parts by time, each written to a folder when asked for: (folder, part's folder)."""
    events = raw(spark, folder, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    shares = [n / ARRIVALS for n in range(1, ARRIVALS)]
    cuts = events.agg(F.percentile_approx(micros, shares, 10_000)).first()[0] or [0] * len(shares)
    path = fresh_path(spark, "arrivals")
    for n, (low, high) in enumerate(zip([-(1 << 62), *cuts], [*cuts, 1 << 62], strict=True)):
        part = f"{path}/part{n}"
        events.filter((micros >= low) & (micros < high)).write.parquet(part)
        yield path, part


def _arrived(spark: SparkSession, path: str) -> DataFrame:
    """The stream of all parts there are, each one micro-batch, as their files are in no order of time."""
    raw_events = streams.event_stream(spark, path, RAW["events"], files_per_trigger=100_000, nested=True)
    return streams.shop_events(shop_rows(raw_events), LATE)


def _streamed_session_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of the sessions closed at the end of a stream that is started anew for every part of the events."""
    out, progress = fresh_path(spark, "session-pairs"), fresh_path(spark, "session-progress")
    for path, _ in _arrivals(spark, folder):
        rows = streams.session_pair_rows(streams.sessions(_arrived(spark, path), SESSION_GAP))
        streams.append_to(rows, out, progress).awaitTermination()
    return streams.count_session_pairs(spark.read.schema(rows.schema).parquet(out))


def _streamed_carts(spark: SparkSession, folder: str) -> DataFrame:
    """Recommendations for carts kept by a stream that is started anew for every part; the last part is delivered
    again after compaction."""
    table = carts.CartTable(spark, fresh_path(spark, "carts"), keep=None)
    progress = fresh_path(spark, "carts-progress")
    for n, (path, part) in enumerate(_arrivals(spark, folder)):
        carts.keep_carts(_arrived(spark, path), table, progress).awaitTermination()
        if n:
            table.compact()
    again = streams.shop_events(shop_rows(spark.read.schema(RAW["events"]).parquet(part)))
    table.upsert(again, 0)
    stages = flow(spark, folder)
    recs = staged(_recs(stages), "recs")
    return streams.recommend_for_carts(table.carts(), recs, stages.region_of_customer, LOOKUP["top_n"])


def _streamed(spark: SparkSession, folder: str) -> DataFrame:
    """Shop events written by a stream over the events file, read back."""
    cleaned = streams.shop_events(
        shop_rows(streams.event_stream(spark, folder, RAW["events"], glob="events*.parquet"))
    )
    path = fresh_path(spark, "events")
    streams.append_to(cleaned, path, fresh_path(spark, "events-progress")).awaitTermination()
    return spark.read.schema(cleaned.schema).parquet(path)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return streams.shop_events(shop_rows(raw(spark, folder, "events")))


def _live(spark: SparkSession, folder: str) -> DataFrame:
    stages = flow(spark, folder)
    recs = staged(_recs(stages), "recs")
    return streams.live_recommendations(_events(spark, folder), recs, stages.region_of_customer, LOOKUP["top_n"])


def _carts(spark: SparkSession, folder: str) -> DataFrame:
    stages = flow(spark, folder)
    recs = staged(_recs(stages), "recs")
    return streams.cart_recommendations(_events(spark, folder), recs, stages.region_of_customer, LOOKUP["top_n"])


EVENT_STAGES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_events": _streamed,
    "sessions": lambda spark, folder: streams.sessions(_events(spark, folder), SESSION_GAP).drop("seen"),
    "session_pairs": lambda spark, folder: streams.session_pairs(
        streams.sessions(_events(spark, folder), SESSION_GAP)
    ),
    "cart_abandonment": lambda spark, folder: streams.abandoned_carts(_events(spark, folder), CART_WAIT),
    "hourly_profile": lambda spark, folder: streams.hourly_profile(
        streams.hourly_counts(_events(spark, folder))
    ),
    "live_recommendations": _live,
    "cart_recommendations": _carts,
    "stream_session_pairs": _streamed_session_pairs,
    "stream_cart_recommendations": _streamed_carts,
    "stored_base_transactions": _stored_base,
    "stored_season_buyers": _seasonal,
    "refreshed_base_transactions": lambda spark, folder: _refreshed(spark, folder).base,
    "refreshed_type_counts": lambda spark, folder: refresh.type_counts(_refreshed(spark, folder).items),
    "refreshed_regions": lambda spark, folder: _refreshed(spark, folder).regions,
    "refreshed_sku_pairs": lambda spark, folder: _refreshed(spark, folder).pairs,
}


def _event_query(name: str, stage) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(stage(tuned(spark), folder), DIGITS.get(name, 6))

    run.__name__ = name
    return run


def _query(
    name: str, stage: Callable[[Flow], DataFrame], as_of: dt.date = AS_OF
) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(stage(flow(tuned(spark), folder, last=name, as_of=as_of)), DIGITS.get(name, 6))

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: _query(name, stage) for name, stage in STAGES.items()}
    found.update({f"{name}_past": _query(name, STAGES[name], PAST) for name in PAST_STAGES})
    found["pair_hits_later"] = _event_query("pair_hits_later", _later_hits)
    found.update({name: _event_query(name, stage) for name, stage in EVENT_STAGES.items()})
    return found
