"""Score vectors per customer: pivot, best types, clusters."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.functions.lineage import staged
from basketry.params import ClusterParams

TYPE = "pdm_prod_type_id"


def pivot_scores(
    scores: DataFrame, type_ids: Sequence[int], key: str = "customer_id", on_duplicate: str = "raise"
) -> DataFrame:
    """One row per customer with a column p<id> per type.

    The ids are given, so training and scoring get the same columns. Scores are brought to one cell per customer and
    type first, within each task before they are dealt out, and the cells then into one array per customer.
    A customer with two scores for a listed type is an error, unless `on_duplicate` is "max".
    """
    if on_duplicate not in ("raise", "max"):
        raise ValueError(f"on_duplicate must be raise or max: {on_duplicate}")
    cell = F.max("p")
    if on_duplicate == "raise":
        message = F.concat(
            F.lit("two scores for customer and type "), F.first(F.col(key).cast("string")), F.lit(" "),
            F.first(F.col(TYPE).cast("string")),
        )
        twice = (F.count(F.lit(1)) > 1) & F.first(F.col(TYPE)).isin(*type_ids)
        cell = F.when(twice, F.raise_error(message)).otherwise(cell)
    wide = scores.groupBy(key).pivot(TYPE, list(type_ids)).agg(cell)
    return wide.select(key, *[F.col(f"`{t}`").alias(f"p{t}") for t in type_ids])


def top_types_per_customer(scores: DataFrame, n: int = 4, key: str = "customer_id") -> DataFrame:
    """The n most likely types of every customer; equal scores by the raw score if there is one, then by id."""
    ties = [F.desc("raw_p")] if "raw_p" in scores.columns else []
    best = Window.partitionBy(key).orderBy(F.desc("p"), *ties, TYPE)
    ranked = scores.withColumn("rn", F.row_number().over(best).cast("bigint"))
    return ranked.filter(F.col("rn") <= n)


def default_clusters(rows: int) -> int:
    return max(2, round(math.log10(rows))) if rows > 0 else 2


def _vectors(wide: DataFrame, params: ClusterParams, key: str) -> PipelineModel:
    """All columns but the key as the vector that distances are measured in."""
    columns = [c for c in wide.columns if c != key]
    vectors = VectorAssembler(inputCols=columns, outputCol="_raw", handleInvalid="error")
    scaler = StandardScaler(
        inputCol="_raw", outputCol="_vector", withMean=params.standardize, withStd=params.standardize
    )
    return Pipeline(stages=[vectors, scaler]).fit(wide)


def _kmeans(clusters: int, params: ClusterParams, seed: int) -> KMeans:
    return KMeans(k=clusters, maxIter=params.max_iter, seed=seed, featuresCol="_vector", predictionCol="_cluster")


def cluster_choices(
    wide: DataFrame, candidates: Sequence[int], params: ClusterParams, key: str = "customer_id"
) -> list[tuple[int, int, float | None]]:
    """(clusters, seed, silhouette) per number of clusters tried; None where the rows fall into one cluster.

    The scaled vectors are written once. Of `params.starts` fits per number the one of least cost counts. The
    silhouette (squared distances) needs each cluster's size, sums and squared norms only, no distances of pairs.
    Fits run several at a time: each is many short jobs, which leave executors idle.
    """
    vectors = staged(_vectors(wide, params, key).transform(wide).select("_vector"), "cluster-vectors")
    judge = ClusteringEvaluator(featuresCol="_vector", predictionCol="_cluster")
    numbers, seeds = sorted(set(candidates)), range(params.seed, params.seed + params.starts)

    def fit(choice: tuple[int, int]) -> KMeansModel:
        return _kmeans(choice[0], params, choice[1]).fit(vectors)

    def silhouette(model: KMeansModel) -> float | None:
        several = sum(size > 0 for size in model.summary.clusterSizes) > 1
        return judge.evaluate(model.transform(vectors)) if several else None

    tried = list(product(numbers, seeds))
    with ThreadPoolExecutor(params.parallelism) as pool:
        fits = dict(zip(tried, pool.map(fit, tried), strict=True))
        best = [min((t for t in tried if t[0] == n), key=lambda t: (fits[t].summary.trainingCost, t[1])) for n in numbers]
        judged = pool.map(silhouette, [fits[t] for t in best])
        return [(*choice, value) for choice, value in zip(best, judged, strict=True)]


def best_choice(choices: Sequence[tuple[int, int, float | None]]) -> tuple[int, int]:
    """(clusters, seed) of the largest silhouette, of equal ones the fewest clusters."""
    known = [c for c in choices if c[2] is not None] or [(*c[:2], 0.0) for c in choices]
    clusters, seed, _ = max(known, key=lambda c: (c[2], -c[0]))
    return clusters, seed


def fit_clusters(wide: DataFrame, params: ClusterParams, key: str = "customer_id") -> PipelineModel:
    """K-means over all columns but the key, with as many clusters as the parameters say or choose."""
    prepared = _vectors(wide, params, key)
    if params.candidates:
        clusters, seed = best_choice(cluster_choices(wide, params.candidates, params, key))
    else:
        clusters, seed = params.clusters or default_clusters(wide.count()), params.seed
    return PipelineModel([*prepared.stages, _kmeans(clusters, params, seed).fit(prepared.transform(wide))])


def assign_clusters(wide: DataFrame, model: PipelineModel) -> DataFrame:
    """All input columns and CENTROID_ID, counted from 1."""
    return model.transform(wide).select(
        (F.col("_cluster") + 1).cast("bigint").alias("CENTROID_ID"), *wide.columns
    )


def centroids(model: PipelineModel) -> list[list[float]]:
    """Cluster centres in the scaled space the model measures distances in."""
    return [[float(x) for x in centre] for centre in model.stages[-1].clusterCenters()]


def nearest_centroid(
    wide: DataFrame, centres: Sequence[Sequence[float]], columns: Sequence[str]
) -> DataFrame:
    """CENTROID_ID of the nearest of the given centres, the lower id on equal distance."""
    def squared(centre) -> Column:
        point = F.array(*[F.col(c) for c in columns])
        target = F.array(*[F.lit(float(x)) for x in centre])
        gaps = F.zip_with(point, target, lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda acc, d: acc + d)

    ranked = F.least(*[
        F.struct(squared(centre).alias("d"), F.lit(i).cast("bigint").alias("id"))
        for i, centre in enumerate(centres, start=1)
    ])
    return wide.select(ranked["id"].alias("CENTROID_ID"), *wide.columns)
