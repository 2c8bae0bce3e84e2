"""Properties of fitted models and of what is made of their scores."""

import math
import dataclasses
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from basketry.functions.lineage import fresh_path
from basketry.functions.lineage import staged
from basketry.operators import calibration, factorization, monitoring, propensity, segments
from basketry.params import ClusterParams, FactorParams, TreeParams
from basketry.plans import registry

FEATURES = ("a", "b")
TREES = TreeParams(trees=3, max_depth=2, learning_rate=0.3, feature_share=1.0, train_share=1.0,
                   calibration="none", parallelism=2)


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(3)
    data = []
    for n in range(400):
        kind = rng.choice([10, 20, 30])
        # Feature a tells type 10 apart; b is noise.
        data.append((n, kind, 5.0 + rng.random() if kind == 10 else rng.random(), rng.random()))
    return spark.createDataFrame(data, "customer_id bigint, pdm_prod_type_id bigint, a double, b double")


@pytest.fixture(scope="module")
def trained(spark, training):
    folder = fresh_path(spark, "models")
    return propensity.train_propensity(training, [10, 20], folder, TREES, FEATURES), folder


def test_scores(spark, training, trained):
    models, _ = trained
    scores = propensity.propensity_scores(training, models, FEATURES)
    assert scores.columns == ["customer_id", "p", "pdm_prod_type_id"]
    assert scores.count() == 800
    assert scores.groupBy("customer_id", "pdm_prod_type_id").count().filter("count > 1").count() == 0
    assert scores.filter("p < 0 or p > 1").count() == 0
    labelled = scores.filter("pdm_prod_type_id = 10").join(
        training.select("customer_id", (F.col("pdm_prod_type_id") == 10).cast("double").alias("label")),
        "customer_id",
    )
    area = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label").evaluate(labelled)
    assert area > 0.9


def test_saved_models_score_the_same(spark, training, trained, rows):
    models, folder = trained
    loaded = propensity.load_models(spark, [10, 20], folder)
    assert rows(propensity.propensity_scores(training, loaded, FEATURES)) == rows(
        propensity.propensity_scores(training, models, FEATURES)
    )


def test_missing_model_is_skipped_and_none_is_an_error(spark, training, trained):
    _, folder = trained
    assert list(propensity.load_models(spark, [10, 99], folder)) == [10]
    with pytest.raises(ValueError):
        propensity.propensity_scores(training, propensity.load_models(spark, [99], folder), FEATURES)


def test_rerun_keeps_finished_models(spark, training, trained):
    models, folder = trained
    again = propensity.train_propensity(training, [10, 30], folder, TREES, FEATURES)
    assert sorted(again) == [10, 30]
    assert again[10].uid == models[10].uid
    manifest = {r.pdm_prod_type_id: (r.n_rows, r.trees) for r in propensity.read_manifest(spark, folder).collect()}
    assert manifest == {10: (400, 3), 20: (400, 3), 30: (400, 3)}


def test_new_rows_and_new_settings_refit(spark, training):
    folder = fresh_path(spark, "models")

    def train(rows, params):
        models = propensity.train_propensity(rows, [10], folder, params, FEATURES)
        entry = propensity.read_manifest(spark, folder).first()
        return models[10], entry

    first, entry = train(training, TREES)
    # The same rows in another order are the same run.
    again, same = train(training.repartition(3), TREES)
    assert again.uid == first.uid and same == entry
    deeper, changed = train(training, dataclasses.replace(TREES, trees=5))
    assert (deeper.getNumTrees, changed.trees) == (5, 5) and changed.run != entry.run
    later, grown = train(training.union(training.limit(10)), dataclasses.replace(TREES, trees=5))
    assert grown.n_rows == 410 and later.uid != deeper.uid
    # The manifest names the latest run, and that is what is loaded.
    assert propensity.load_models(spark, [10], folder)[10].uid == later.uid


def test_weighted_training(spark, training):
    heavy = TreeParams(trees=2, max_depth=2, learning_rate=0.3, feature_share=1.0, train_share=1.0,
                       positive_weight=5.0, calibration="none")
    models = propensity.train_propensity(training, [20], fresh_path(spark, "models"), heavy, FEATURES)
    plain = propensity.train_propensity(training, [20], fresh_path(spark, "models"), TREES, FEATURES)
    mean = [
        propensity.propensity_scores(training, m, FEATURES).agg(F.avg("p")).first()[0] for m in (models, plain)
    ]
    assert mean[0] > mean[1]


def test_sampling_repeats_whatever_the_layout(spark, training, rows):
    some = propensity.sample_rows(training, 0.6, 42)
    assert rows(some) == rows(propensity.sample_rows(training.repartition(5), 0.6, 42))
    assert 0.5 < some.count() / 400 < 0.7


def test_importance(spark, trained):
    models, _ = trained
    shares = propensity.feature_importance(models, spark, FEATURES).filter("pdm_prod_type_id = 10").collect()
    assert math.isclose(sum(r.importance for r in shares), 1.0)
    assert {r.feature: r.importance for r in shares}["a"] > 0.9


def test_calibration(spark):
    data = [(1, x / 10, float((x * 7) % 10 < x)) for x in range(10) for _ in range(3)]
    data += [(2, 0.5, 1.0), (2, 0.5, 0.0)]
    scored = spark.createDataFrame(data, "pdm_prod_type_id bigint, p double, y double")
    curves = calibration.fit_calibration(scored, [1, 2])
    wanted = scored.select("pdm_prod_type_id", "p").distinct().union(
        spark.createDataFrame([(1, -1.0), (1, 2.0), (1, 0.05), (2, 0.9)], "t bigint, p double")
    )
    found = {(r.pdm_prod_type_id, r.p): r.calibrated for r in calibration.calibrate_scores(wanted, curves).collect()}
    points = [x / 10 for x in range(10)]
    mean = {p: sum(y for t, q, y in data if t == 1 and q == p) / 3 for p in points}
    for k, p in enumerate(points):
        best = max(
            min(sum(mean[q] for q in points[i:j + 1]) / (j + 1 - i) for j in range(k, 10)) for i in range(k + 1)
        )
        assert math.isclose(found[1, p], best, abs_tol=1e-9)
    assert found[1, -1.0] == found[1, 0.0] and found[1, 2.0] == found[1, 0.9]
    assert found[1, 0.0] <= found[1, 0.05] <= found[1, 0.1]
    assert found[2, 0.5] == found[2, 0.9] == 0.5


def brute_isotonic(points):
    """Fitted value by score: the best lower start of the best upper mean."""
    found = {}
    for k, (p, *_) in enumerate(points):
        found[p] = max(
            min(sum(y for _, y, _ in points[i:j + 1]) / sum(n for *_, n in points[i:j + 1]) for j in range(k, len(points)))
            for i in range(k + 1)
        )
    return found


def test_calibration_over_many_tasks(spark):
    rng = random.Random(3)
    # Type 1 has most rows, a third of all at one score; types 3 and 4 rise and fall all the way.
    data = [(1, 0.25 if rng.random() < 0.4 else round(rng.random(), 2), float(rng.random() < 0.3), i) for i in range(3000)]
    data += [(3, i / 40, float(i >= 20), i) for i in range(40)] + [(4, i / 40, float(i < 20), i) for i in range(40)]
    data += [(2, None, 1.0, 0), (2, 0.5, None, 0), (2, float("nan"), 1.0, 0), (2, 0.5, 1.0, 1)]
    scored = spark.createDataFrame(data, "pdm_prod_type_id bigint, p double, y double, line long").repartition(7)
    curves = staged(calibration.fit_calibration(scored), "curves")
    assert curves.filter("pdm_prod_type_id = 4").count() == 3 and curves.columns[1:] == ["score", "value", "next_score", "next_value"]
    rows = calibration.calibrate_scores(scored, curves).collect()
    assert sorted(((r.pdm_prod_type_id, r.line, str(r.p)) for r in rows)) == sorted((t, i, str(p)) for t, p, _, i in data)
    for t in (1, 2, 3, 4):
        sums = {}
        for u, p, y, _ in data:
            if u == t and p is not None and p == p and y is not None:
                s, n = sums.get(p, (0, 0))
                sums[p] = (s + y, n + 1)
        want = brute_isotonic([(p, *sums[p]) for p in sorted(sums)])
        for r in rows:
            if r.pdm_prod_type_id == t and r.p is not None and r.p == r.p:
                assert math.isclose(r.calibrated, want[r.p], abs_tol=1e-12)
    assert sum(r.calibrated is None for r in rows) == 2
    between = spark.createDataFrame([(3, 0.4875 + 1e-6, 1), (9, 0.5, 1)], "pdm_prod_type_id bigint, p double, score long")
    got = calibration.calibrate_scores(between, curves, "p").collect()
    assert len(got) == 1 and got[0].score == 1 and math.isclose(got[0].p, 0.5, abs_tol=1e-3)
    assert calibration.calibrate_scores(scored, curves.limit(0)).count() == 0


def test_pooling_runs_first_changes_nothing():
    rng = random.Random(4)
    points = [(i, i, float(rng.randrange(4)), 3.0) for i in range(200)]
    whole = next(calibration.pooled((1, p) for p in points))[1]
    parts = []
    for low in range(0, 200, 23):
        parts += next(calibration.pooled((1, p) for p in points[low:low + 23]))[1]
    assert next(calibration.pooled((1, p) for p in parts))[1] == whole and len(whole) < 200


def test_merged_sketches_keep_their_rank_error(spark):
    scores = spark.range(60_000).select(
        F.pmod("id", F.lit(3)).alias("pdm_prod_type_id"), F.pmod("id", F.lit(11)).alias("day"),
        F.when(F.col("id") % 5 == 0, 0.25).otherwise(F.rand(4)).alias("p"),
    ).union(spark.createDataFrame([(0, 1, None), (0, 1, float("nan"))], "t long, d long, p double"))
    scores = staged(scores, "scores")
    shares = (0.01, 0.1, 0.5, 0.9, 0.99)
    merged = monitoring.merged_sketches(monitoring.score_sketches(scores, ["pdm_prod_type_id", "day"]))
    for r in monitoring.sketch_quantiles(merged, shares).collect():
        own = scores.filter((F.col("pdm_prod_type_id") == r.pdm_prod_type_id) & F.col("p").isNotNull() & ~F.isnan("p"))
        n, below, upto = own.agg(
            F.count(F.lit(1)), F.count_if(F.col("p") < r.p), F.count_if(F.col("p") <= r.p)).first()
        assert r.n == n == 20_000
        assert below / n - 0.03 <= r.share <= upto / n + 0.03


def test_bootstrap_interval_covers_the_difference(spark):
    covered = 0
    for seed in range(12):
        rng = random.Random(seed)
        rows = []
        for c in range(150):
            level = rng.gauss(0, 1)  # a customer's rows go together, so rows alone would give too short an interval
            rows += [(c, c % 2, level + rng.gauss(0, 0.1) + 0.5 * (c % 2)) for _ in range(1 + c % 9)]
        df = spark.createDataFrame([*rows, (None, 1, 5.0), (1, 1, None), (2, 9, 99.0)], "customer_id long, arm long, v double")
        got = monitoring.bootstrap_difference(df.repartition(1 + seed % 4), "arm", "v", (0, 1), replicates=150).first()
        again = monitoring.bootstrap_difference(df.coalesce(1), "arm", "v", (0, 1), replicates=150).first()
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[:3], again[:3])) and got.low < got.difference < got.high
        covered += got.low <= 0.5 <= got.high
    assert covered >= 9
    assert monitoring.bootstrap_difference(df.limit(0), "arm", "v", (0, 1)).first()[:3] == (None, None, None)


def long_scores(spark, *data):
    return spark.createDataFrame(list(data), "customer_id bigint, pdm_prod_type_id bigint, p double")


def test_pivot(spark, rows):
    scores = long_scores(spark, (1, 10, 0.1), (1, 20, 0.2), (2, 20, 0.3), (2, 99, 0.9))
    assert rows(segments.pivot_scores(scores, [20, 10, 30])) == [(1, 0.2, 0.1, None), (2, 0.3, None, None)]
    twice = scores.union(long_scores(spark, (1, 10, 0.5)))
    with pytest.raises(Exception, match="two scores for customer and type 1 10"):
        segments.pivot_scores(twice, [10]).collect()
    assert rows(segments.pivot_scores(twice, [10], on_duplicate="max"), "p10") == [(0.5,), (None,)]
    with pytest.raises(ValueError):
        segments.pivot_scores(scores, [10], on_duplicate="first")


def test_top_types_break_ties_by_raw_score_then_id(spark, rows):
    scores = long_scores(spark, *[(1, t, 0.5) for t in (30, 10, 20, 40, 50)]).withColumn(
        "raw_p", F.when(F.col("pdm_prod_type_id") == 40, 0.9).otherwise(0.1)
    )
    best = segments.top_types_per_customer(scores, 4)
    assert rows(best, "rn", "pdm_prod_type_id") == [(1, 40), (2, 10), (3, 20), (4, 30)]


def test_clusters(spark):
    rng = random.Random(4)
    data = [(n, n % 2 + rng.random() / 10, 5 * (n % 2) + rng.random()) for n in range(60)]
    wide = spark.createDataFrame(data, "customer_id bigint, p1 double, p2 double")
    model = segments.fit_clusters(wide, ClusterParams(clusters=None, standardize=False))
    assigned = segments.assign_clusters(wide, model)
    assert assigned.columns == ["CENTROID_ID", "customer_id", "p1", "p2"]
    nearest = segments.nearest_centroid(wide, segments.centroids(model), ["p1", "p2"])
    both = assigned.join(nearest.select("customer_id", F.col("CENTROID_ID").alias("n")), "customer_id")
    assert both.filter("CENTROID_ID != n").count() == 0
    assert sorted(r.n for r in monitoring.cluster_sizes(assigned).collect()) == [30, 30]
    assert [segments.default_clusters(n) for n in (0, 5, 1000, 10**6)] == [2, 2, 3, 6]


def test_factor_model(spark, folder):
    f = registry.flow(spark, folder)
    ids = f.surrogate_ids
    n_types = ids.count()
    indexed = factorization.indexed_ratings(f.regional_ratings, ids)
    regions = ["South", "UNKNOWN"]
    params = FactorParams(rank=4, max_iter=3)
    models = factorization.fit_regional_als(indexed, regions, params)
    scores = factorization.seed_scores(models, indexed, 7)
    assert scores.count() == len(regions) * n_types * 7
    # Each score is the product of the saved factors.
    user = indexed.filter("region = 'South' and customer_id < 0").select(
        "customer_id", F.col("user_index").alias("id")
    ).join(models["South"].userFactors, "id").select("customer_id", F.col("features").alias("u"))
    item = indexed.filter("customer_id < 0").select(
        "pdm_prod_type_id", F.col("item_index").alias("id")
    ).distinct().join(models["South"].itemFactors, "id").select("pdm_prod_type_id", F.col("features").alias("v"))
    for row in scores.filter("region = 'South'").join(user, "customer_id").join(item, "pdm_prod_type_id").collect():
        assert math.isclose(row.confidence, sum(a * b for a, b in zip(row.u, row.v)), abs_tol=1e-4)
    recs = f.recommendations(scores)
    assert recs.filter("focus_pdm_prod_type_id = recomm_pdm_prod_type_id").count() == 0
    for group in recs.groupBy("region", "focus_pdm_prod_type_id").agg(
        F.sort_array(F.collect_list(F.struct("rn", "predicted_trans_count_confidence"))).alias("r")
    ).collect():
        assert [x.rn for x in group.r] == list(range(1, len(group.r) + 1))
        values = [x.predicted_trans_count_confidence for x in group.r]
        assert values == sorted(values, reverse=True)
    saved = fresh_path(spark, "factors")
    factorization.save_models(models, saved)
    assert factorization.load_models(saved, regions)["South"].rank == 4
