"""The four jobs, end to end with small models."""

import dataclasses
import os

import pytest

from basketry.functions.lineage import fresh_path, shared_dir, stages_removed
from basketry.params import ClusterParams, FactorParams, PairParams, ReactivationParams, TreeParams
from basketry.plans.jobs import JobParams, Jobs
from basketry.sources.fixtures import AS_OF, EARLIEST_PREVIOUS, retail_tables

PARAMS = JobParams(
    PairParams(AS_OF, rank_limit=10),
    ReactivationParams(AS_OF, earliest_previous=EARLIEST_PREVIOUS, top_types=4),
    factors=FactorParams(rank=3, max_iter=2, min_support=2),
    trees=TreeParams(trees=2, max_depth=2, train_share=1.0),
    clusters=ClusterParams(clusters=2),
)


@pytest.fixture(scope="module")
def jobs(spark, folder):
    return Jobs(spark, retail_tables(spark, folder), fresh_path(spark, "jobs"), PARAMS)


def test_pairs(spark, jobs):
    before = set(os.listdir(shared_dir(spark)))
    with stages_removed(spark):
        recs, described, mined = jobs.type_pairs(), jobs.sku_pairs(), jobs.mined_reference()
    # Results are whole without the stages, of which none is left beside the job's folder.
    assert set(os.listdir(shared_dir(spark))) - before <= {os.path.basename(jobs.out), "rdd"}
    assert recs.select("region").distinct().count() == 5
    assert recs.filter("rn > 10 or focus_pdm_prod_type_id = recomm_pdm_prod_type_id").count() == 0
    assert described.filter("focus_type IS NULL OR recomm_type IS NULL OR sku_rank < 1").count() == 0
    kept = mined.filter("product_type_rank > 0")
    assert 0 < kept.count() <= spark.read.parquet(f"{jobs.out}/type_pair_reference").filter("product_type_rank > 0").count()


@pytest.mark.parametrize("method", ["histogram", "node"])
def test_train_and_score(spark, folder, method):
    params = dataclasses.replace(PARAMS, trees=dataclasses.replace(PARAMS.trees, method=method))
    jobs = Jobs(spark, retail_tables(spark, folder), fresh_path(spark, "jobs"), params)
    trained = jobs.train()
    scored = jobs.score()
    assert trained.columns == scored.columns
    assert trained.columns[:2] == ["CENTROID_ID", "customer_id"]
    # Four types, the first one skipped.
    assert len(scored.columns) == 2 + 3
    listed = spark.read.parquet(f"{jobs.out}/scoring_customers")
    n_scored = scored.count()
    assert n_scored == listed.select("customer_id").distinct().count()
    assert scored.filter("CENTROID_ID NOT IN (1, 2)").count() == 0
    best = spark.read.parquet(f"{jobs.out}/scoring_top_types")
    assert best.groupBy("customer_id").count().filter("count > 4").count() == 0
    assert "raw_p" in best.columns
    # A second run of the day keeps the written scores.
    assert jobs.score().count() == n_scored


def test_trial_run_into_a_database(spark, folder, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS results LOCATION '{tmp_path}'")
    try:
        params = dataclasses.replace(
            PARAMS, training_limit=5, scoring_limit=6, database="results",
            clusters=ClusterParams(candidates=(2, 3), starts=1),
        )
        jobs = Jobs(spark, retail_tables(spark, folder), fresh_path(spark, "jobs"), params)
        jobs.train()
        assert spark.read.parquet(f"{jobs.out}/limited_training").count() == 5
        scored = jobs.score()
        customers = spark.read.parquet(f"{jobs.out}/scoring_customers").select("customer_id").distinct()
        first = sorted(r["customer_id"] for r in customers.collect())[:6]
        assert sorted(r["customer_id"] for r in scored.collect()) == first
        assert spark.table("results.clusters").count() == 6
        assert spark.table("results.training_clusters").columns[:2] == ["CENTROID_ID", "customer_id"]
        assert spark.table("results.scoring_top_types").count() > 0
    finally:
        spark.sql("DROP DATABASE results CASCADE")
