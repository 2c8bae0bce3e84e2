"""Options of the command entries reach the jobs."""

from basketry.functions.lineage import fresh_path
from basketry.plans import cli


def test_options(spark, folder):
    listed = fresh_path(spark, "listed")
    spark.createDataFrame([(5,), (6,)], "customer_id bigint").write.parquet(listed)
    jobs = cli._jobs("test", [
        "--folder", folder, "--out", fresh_path(spark, "out"), "--as-of", "2022-08-31", "--trees", "3",
        "--calibration", "none", "--clusters", "6", "--pair-months", "4", "--min-support", "9",
        "--customers", listed, "--types", "30,10", "--skip-types", "2",
        "--clusters-from", "2,3", "--training-limit", "50", "--scoring-limit", "7", "--out-database", "results",
        "--if-exists", "append",
    ])
    p = jobs.params
    assert (p.trees.trees, p.trees.calibration, p.clusters.clusters) == (3, "none", 6)
    assert (p.pairs.window_months, p.factors.min_support, p.skip_types) == (4, 9, 2)
    assert p.returns.as_of == p.pairs.as_of and p.pairs.as_of.isoformat() == "2022-08-31"
    assert jobs.flow.shopping_types() == [10, 30]
    assert jobs.flow._listed.count() == 2
    assert p.clusters.candidates == (2, 3) and (p.training_limit, p.scoring_limit) == (50, 7)
    assert (p.database, p.if_exists) == ("results", "append")
