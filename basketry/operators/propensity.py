"""One boosted-tree classifier per product type: fit, save, score."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.lineage import staged, use_checkpoints
from basketry.operators.features import impute_features
from basketry.params import FEATURES, TreeParams

log = logging.getLogger(__name__)

TYPE = "pdm_prod_type_id"
SHARE_STEPS = 1_000_000
# Tree nodes sent to a task at once: about 50 MB of models.
GROUP_NODES = 400_000


def sample_rows(df: DataFrame, share: float, seed: int) -> DataFrame:
    """A repeatable share of the rows: chosen by a hash of the row, not by where it is stored."""
    if share >= 1:
        return df
    place = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns]), F.lit(SHARE_STEPS))
    return df.filter(place < int(share * SHARE_STEPS))


def assembled(df: DataFrame, features: Sequence[str] = FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """Imputed features as one vector column next to the columns to keep."""
    vectors = VectorAssembler(inputCols=[f"_f_{f}" for f in features], outputCol="features")
    filled = impute_features(df.select(*keep, *[F.col(f).alias(f"_f_{f}") for f in features]),
                             [f"_f_{f}" for f in features])
    return vectors.transform(filled).select(*keep, "features")


def binary_target(df: DataFrame, value: int, column: str = TYPE, name: str = "label") -> DataFrame:
    """1.0 where the column has the value, else 0.0."""
    return df.withColumn(name, F.when(F.col(column) == value, 1.0).otherwise(0.0))


def classifier(params: TreeParams) -> GBTClassifier:
    gbt = GBTClassifier(
        labelCol="label",
        featuresCol="features",
        stepSize=params.learning_rate,
        maxIter=params.trees,
        maxDepth=params.max_depth,
        minInfoGain=params.min_gain,
        subsamplingRate=params.row_share,
        featureSubsetStrategy=str(params.feature_share),
        seed=params.seed,
        checkpointInterval=params.checkpoint_interval,
    )
    return gbt if params.positive_weight == 1 else gbt.setWeightCol("weight")


# Settings that do not change a fitted model.
_RUN_ONLY = ("parallelism", "checkpoint_interval", "calibration", "method")


def run_id(training: DataFrame, params: TreeParams, features: Sequence[str] = FEATURES) -> str:
    """Names what a model was fitted to: the rows, whatever their order, the features and the settings."""
    columns = [F.col(c) for c in (TYPE, *features)]
    row_hash = F.xxhash64(*columns).cast("decimal(38,0)")
    rows, total = training.agg(F.count(F.lit(1)), F.sum(row_hash)).first()
    settings = sorted((k, v) for k, v in asdict(params).items() if k not in _RUN_ONLY)
    return hashlib.sha256(repr((rows, str(total), tuple(features), settings)).encode()).hexdigest()[:16]


def model_path(folder: str, run: str, type_id: int) -> str:
    return f"{folder}/run={run}/type={type_id}"


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per saved model; no rows if nothing was trained yet."""
    schema = f"{TYPE} bigint, n_rows bigint, n_positive bigint, trees bigint, run string"
    try:
        return spark.read.schema(schema).parquet(f"{folder}/manifest").select(
            TYPE, "n_rows", "n_positive", "trees", "run"
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _record(
    spark: SparkSession, folder: str, type_id: int, n_rows: int, n_positive: int, trees: int, run: str
) -> None:
    # A folder per type: fits finish at the same time, and commits to one folder would collide.
    schema = "n_rows bigint, n_positive bigint, trees bigint, run string"
    entry = spark.createDataFrame([(n_rows, n_positive, trees, run)], schema)
    entry.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest/{TYPE}={type_id}")


def train_propensity(
    training: DataFrame,
    type_ids: Sequence[int],
    folder: str,
    params: TreeParams,
    features: Sequence[str] = FEATURES,
) -> dict[int, GBTClassificationModel]:
    """Fit and save a model per type; every model sees all sampled rows, its own type as positives.

    The feature vectors are written once for all fits. Several fits run at a time, so that small fits share
    the cluster. Each finished model is added to the manifest. A rerun on the same rows with the same settings
    loads it instead of fitting again; other rows or settings are another run, fitted anew in a folder of its
    own, and the manifest names the latest finished model of each type.
    """
    spark = training.sparkSession
    use_checkpoints(spark)
    run = run_id(training, params, features)
    finished = {row[TYPE] for row in read_manifest(spark, folder).filter(F.col("run") == run).select(TYPE).collect()}
    sampled = sample_rows(training, params.train_share, params.seed)
    rows = staged(assembled(sampled, features, keep=[TYPE]), "training")
    todo = [t for t in type_ids if t not in finished]
    # One pass counts the positives of all types; the rows of types asked for are at most their number.
    n_rows = rows.count()
    counted = rows.groupBy(TYPE).count().filter(F.col(TYPE).isin(*todo)) if todo else None
    positives = {row[TYPE]: row["count"] for row in counted.collect()} if todo else {}
    gbt = classifier(params)

    def fit(type_id: int) -> GBTClassificationModel:
        data = binary_target(rows, type_id)
        if params.positive_weight != 1:
            weight = F.when(F.col("label") == 1, params.positive_weight).otherwise(1.0)
            data = data.withColumn("weight", weight)
        model = gbt.fit(data)
        model.write().overwrite().save(model_path(folder, run, type_id))
        _record(spark, folder, type_id, n_rows, positives.get(type_id, 0), model.getNumTrees, run)
        return model

    with ThreadPoolExecutor(params.parallelism) as pool:
        fitted = dict(zip(todo, pool.map(fit, todo)))
    loaded = load_models(spark, [t for t in type_ids if t in finished], folder, params.parallelism)
    return {t: fitted.get(t) or loaded[t] for t in type_ids}


def load_models(
    spark: SparkSession, type_ids: Sequence[int], folder: str, parallelism: int = 8
) -> dict[int, GBTClassificationModel]:
    """Saved models of the types; types without one are skipped with a warning."""
    known = {row[TYPE]: row["run"] for row in read_manifest(spark, folder).select(TYPE, "run").collect()}
    missing = [t for t in type_ids if t not in known]
    if missing:
        log.warning("no model for product types %s: skipped", missing)
    wanted = [t for t in type_ids if t in known]
    with ThreadPoolExecutor(parallelism) as pool:
        paths = [model_path(folder, known[t], t) for t in wanted]
        return dict(zip(wanted, pool.map(GBTClassificationModel.load, paths)))


def model_groups(
    spark: SparkSession, type_ids: Sequence[int], folder: str, max_depth: int, most_nodes: int = GROUP_NODES
) -> list[list[int]]:
    """The types with a saved model in groups to score together: as many as keep the trees that a task is sent
    below most_nodes nodes, at least one."""
    trees = {r[TYPE]: r["trees"] for r in read_manifest(spark, folder).select(TYPE, "trees").collect()}
    groups, held = [], most_nodes
    for type_id in type_ids:
        nodes = trees.get(type_id, 0) * ((2 << max_depth) - 1)
        if type_id not in trees:
            log.warning("no model for product type %s: skipped", type_id)
            continue
        if held + nodes > most_nodes:
            groups.append([])
            held = 0
        groups[-1].append(type_id)
        held += nodes
    return groups


def propensity_scores(
    customers: DataFrame,
    models: Mapping[int, GBTClassificationModel],
    features: Sequence[str] = FEATURES,
    key: str = "customer_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Probability per customer and type, from one pass over the customers with all models."""
    if not models:
        raise ValueError("no model to score with: train first")
    scored = assembled(customers, features, keep=[key, *keep])
    for type_id, model in models.items():
        single = model.copy()
        single.setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"_p{type_id}")
        scored = single.transform(scored)
    columns = [
        F.struct(
            F.lit(type_id).cast("bigint").alias(TYPE),
            vector_to_array(F.col(f"_p{type_id}"))[1].alias("p"),
        )
        for type_id in models
    ]
    return scored.select(key, *keep, F.inline(F.array(*columns))).select(key, *keep, "p", TYPE)


def feature_importance(
    models: Mapping[int, GBTClassificationModel], spark: SparkSession, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Type, feature and its share in the model: one row per model and feature."""
    rows = [
        (type_id, name, float(share))
        for type_id, model in models.items()
        for name, share in zip(features, model.featureImportances.toArray())
    ]
    return spark.createDataFrame(rows, f"{TYPE} bigint, feature string, importance double")
