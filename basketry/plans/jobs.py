"""The four jobs. Each writes its stages as tables below `out` and can be rerun for any day."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.lineage import complete_folders
from basketry.operators import (
    boosting, calibration, factorization, pairs, propensity, purchases, ranking, refresh, segments,
)
from basketry.params import (
    FEATURES, ClusterParams, FactorParams, PairParams, ReactivationParams, TreeParams,
)
from basketry.plans.flow import Flow
from basketry.session import tuned
from basketry.sources.sinks import checkpoint_scores, finished_partitions, write_table
from basketry.sources.tables import RetailTables, feature_rows, limited

TYPE = "pdm_prod_type_id"


@dataclass(frozen=True)
class JobParams:
    pairs: PairParams
    returns: ReactivationParams
    factors: FactorParams = field(default_factory=FactorParams)
    trees: TreeParams = field(default_factory=TreeParams)
    clusters: ClusterParams = field(default_factory=ClusterParams)
    skip_types: int = 1
    on_duplicate: str = "raise"
    # Customers, by id, a trial run trains on and scores; None takes all.
    training_limit: int | None = None
    scoring_limit: int | None = None
    # Results become tables of this database as well, written this way.
    database: str | None = None
    if_exists: str = "replace"


class Jobs:
    """Jobs over one set of inputs.

    Stages are written once per job run and read back, so a failure repeats one stage at most and later
    jobs of the same run share them.
    """

    def __init__(
        self, spark: SparkSession, tables: RetailTables, out: str, params: JobParams,
        listed: DataFrame | None = None, types: Sequence[int] | None = None,
    ):
        self.spark = tuned(spark)
        self.out = out.rstrip("/")
        self.params = params
        self.flow = Flow(tables, params.pairs, params.returns, self._write, listed, types)

    def _path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        return write_table(df, self._path(name), "replace")

    def _result(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """A result below `out`, which the next jobs read, and in the database if one is named."""
        written = write_table(df, self._path(name), "replace", partition_by)
        if self.params.database:
            write_table(written, f"{self.params.database}.{name}", self.params.if_exists, partition_by)
        return written

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def type_pairs(self) -> DataFrame:
        """Recommended product types per region and focus type."""
        p, f = self.params, self.flow
        ratings = purchases.supported_ratings(f.regional_ratings, f.customer_type_counts, p.factors.min_support)
        ids = self._write(f.surrogate_ids, "surrogate_ids")
        indexed = factorization.indexed_ratings(ratings, ids)
        models = factorization.fit_regional_als(indexed, p.pairs.regions, p.factors)
        factorization.save_models(models, self._path("factor_models"))
        scores = factorization.seed_scores(models, indexed, p.pairs.rank_limit)
        recs = f.recommendations(self._write(scores, "seed_scores"))
        return self._result(recs, "type_recommendations", ["region"])

    def sku_pairs(self) -> DataFrame:
        """SKU pairs of the recommended type pairs, described and ranked. Needs type_pairs."""
        f = self.flow
        reference = self._write(
            ranking.type_pair_reference(self._read("type_recommendations"), self.params.pairs.reference_ranks),
            "type_pair_reference",
        )
        mined = self._write(pairs.sku_pairs(f.regional_history, reference), "sku_pairs")
        self._write(pairs.basket_items(f.base_transactions), "basket_items")
        return self._described(mined, reference)

    def refresh_sku_pairs(self, previous: str, before: dt.date, restated: Sequence[dt.date] = ()) -> DataFrame:
        """SKU pairs of this day from the results of an earlier day's run, by what has changed in between.

        Recommended type pairs stay those of that run; its folder is left as it is. The folder of this run has
        all that the next refresh needs. `restated` are days whose lines were corrected or booked late.
        """
        previous = previous.rstrip("/")
        if previous == self.out:
            raise ValueError("a refresh writes to a folder of its own")

        def earlier(name: str) -> DataFrame:
            return self.spark.read.parquet(f"{previous}/{name}")

        state = refresh.WindowState(*map(earlier, ("base_transactions", "basket_items", "region_of_customer", "sku_pairs")))
        reference = self._write(earlier("type_pair_reference"), "type_pair_reference")
        moved = self.flow.refreshed(state, before, reference, restated)
        return self._described(moved.pairs, reference)

    def _described(self, mined: DataFrame, reference: DataFrame) -> DataFrame:
        f = self.flow
        described = pairs.sku_recommendations(mined, f.sku_dimension, reference)
        return self._result(described, "sku_recommendations", ["region"])

    def mined_reference(self) -> DataFrame:
        """Type pairs with a pair of SKUs to show, from the described SKU pairs. Needs sku_pairs."""
        found = ranking.type_pair_reference(self._read("sku_recommendations"), self.params.pairs.reference_ranks)
        return self._result(found, "mined_type_reference")

    def train(self) -> DataFrame:
        """One model per product type, scores of the training customers, clusters over their scores."""
        p, f = self.params, self.flow
        training = f.reactivation_features
        if p.training_limit is not None:
            order = ["customer_id", *[c for c in training.columns if c != "customer_id"]]
            training = self._write(limited(training, p.training_limit, order), "limited_training")
        types = f.shopping_types(p.skip_types)
        self._write(self.spark.createDataFrame([(t,) for t in types], f"{TYPE} bigint"), "shopping_types")
        if p.trees.method == "histogram":
            self._boost(training, types)
        else:
            propensity.train_propensity(training, types, self._path("models"), p.trees)
        if p.trees.calibration == "isotonic":
            seen = propensity.sample_rows(training, p.trees.train_share, p.trees.seed).withColumnRenamed(
                TYPE, "_bought"
            )
            seen_scores = self._scored(seen, types, "seen_scores", keep=["_bought"]).withColumn(
                "y", F.when(F.col("_bought") == F.col(TYPE), 1.0).otherwise(0.0)
            )
            self._write(
                calibration.fit_calibration(seen_scores, types), "calibration"
            )
        scores = self._scored(feature_rows(training, FEATURES), types, "training_scores")
        wide = self._wide(self._calibrated(scores), "training_vectors")
        model = segments.fit_clusters(wide, p.clusters)
        model.write().overwrite().save(self._path("cluster_model"))
        return self._result(segments.assign_clusters(wide, model), "training_clusters")

    def score(self) -> DataFrame:
        """Scores and clusters of at-risk and lapsed customers. Needs train.

        Scores of finished types are kept from an interrupted run of the same day with the same models.
        """
        rows = feature_rows(self.flow.scoring_features, FEATURES)
        name, limit = f"scores_{self.params.returns.as_of:%Y%m%d}", self.params.scoring_limit
        if limit is not None:
            # Scores of a trial run are not those of the day.
            name = f"{name}_first{limit}"
            rows = self._write(limited(rows, limit, rows.columns), "limited_scoring")
        scores = self._scored(rows, self._types(), name)
        wide = self._wide(self._calibrated(scores), "scoring_vectors")
        clusters = PipelineModel.load(self._path("cluster_model"))
        return self._result(segments.assign_clusters(wide, clusters), "clusters")

    def _scored(self, rows: DataFrame, types: list[int], name: str, keep: Sequence[str] = ()) -> DataFrame:
        """Scores of the rows by all models, written once, a group of types at a time.

        Each group is committed before the next one starts, so an interrupted run goes on with the groups left.
        The path names the models used: other models score anew.
        """
        if not complete_folders(self.spark, self._path("boosted_run" if self.params.trees.method == "histogram" else "shopping_types")):
            raise ValueError("no model to score with: train first")
        checkpoint = self._path(f"{name}_{self._models_id()}")
        done = [t for t in finished_partitions(self.spark, checkpoint, TYPE) if t is not None]
        if self.params.trees.method == "histogram":
            trees = self._trees().filter(~F.col(TYPE).isin(*done)) if done else self._trees()
            for group in boosting.type_groups(trees):
                own = trees.filter(F.col(TYPE).isin(*group))
                checkpoint_scores(boosting.boosted_scores(rows, own, keep=keep), checkpoint)
            return self.spark.read.parquet(checkpoint).withColumn(TYPE, F.col(TYPE).cast("bigint"))
        folder, todo = self._path("models"), [t for t in types if t not in done]
        groups = propensity.model_groups(self.spark, todo, folder, self.params.trees.max_depth)
        if not groups and not done:
            raise ValueError("no model to score with: train first")
        for group in groups:
            models = propensity.load_models(self.spark, group, folder)
            checkpoint_scores(propensity.propensity_scores(rows, models, keep=keep), checkpoint)
        return self.spark.read.parquet(checkpoint).withColumn(TYPE, F.col(TYPE).cast("bigint"))

    def _boost(self, training: DataFrame, types: list[int]) -> None:
        """Trees of all types; a rerun on the same rows with the same settings goes on where it stopped."""
        p = self.params.trees
        run = propensity.run_id(training, p)
        run = hashlib.sha256(repr((run, types)).encode()).hexdigest()[:16]
        boosting.train_boosted(
            propensity.sample_rows(training, p.train_share, p.seed), types, self._path(f"boosted/run={run}"),
            boosting.BoostParams(
                p.learning_rate, p.trees, p.max_depth, gamma=p.min_gain, l2=p.l2, row_share=p.row_share,
                feature_share=p.feature_share, positive_weight=p.positive_weight, fold=p.checkpoint_interval, seed=p.seed,
            ),
        )
        self._write(self.spark.createDataFrame([(run, p.trees)], "run string, trees int"), "boosted_run")

    def _trees(self) -> DataFrame:
        run = self._read("boosted_run").first()
        return boosting.read_trees(self.spark, self._path(f"boosted/run={run['run']}"), run["trees"])

    def _models_id(self) -> str:
        """Names the models in use: the run each modelled type was fitted in."""
        if self.params.trees.method == "histogram":
            return self._read("boosted_run").first()["run"]
        fitted = propensity.read_manifest(self.spark, self._path("models")).select(TYPE, "run").collect()
        wanted = set(self._types())
        runs = sorted((r[TYPE], r["run"]) for r in fitted if r[TYPE] in wanted)
        return hashlib.sha256(repr(runs).encode()).hexdigest()[:16]

    def _types(self) -> list[int]:
        return sorted(r[TYPE] for r in self._read("shopping_types").collect())

    def _calibrated(self, scores: DataFrame) -> DataFrame:
        if self.params.trees.calibration == "none":
            return scores
        return calibration.calibrate_scores(
            scores.withColumn("raw_p", F.col("p")), self._read("calibration"), "p"
        )

    def _wide(self, scores: DataFrame, name: str) -> DataFrame:
        best = segments.top_types_per_customer(scores)
        self._result(best, name.replace("vectors", "top_types"))
        return self._write(
            segments.pivot_scores(scores, self._types(), on_duplicate=self.params.on_duplicate), name
        )
