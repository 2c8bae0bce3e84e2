"""Boosted trees of all types at once against one plain booster per type."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.functions.lineage import fresh_path
from basketry.operators import boosting
from basketry.operators.boosting import BoostParams

COLUMNS = ("a", "b", "c", "d")
ROWS = "pdm_prod_type_id bigint, customer_id bigint, a double, b double, c double, d double"


def made(n=500):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        a, b, c, d = rng.random(), float(rng.randrange(5)), rng.gauss(0, 1), float(rng.randrange(2))
        kind = 10 if a > 0.6 and b < 3 else 20 if c > 0.5 else 30
        rows.append((kind if rng.random() < 0.9 else 99, i, a, b, c, d))
    return rows


def plain_booster(x, y, cuts, params, features):
    """Margins and trees of one type by exhaustive search; all rows and the given features a tree."""
    bins = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], 1)
    base = math.log((y.sum() * params.positive_weight + 0.5) / ((~y).sum() + 0.5))
    margin, trees = np.full(len(x), base), [{0: (None, None, base)}]
    for number in range(1, params.trees + 1):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y, params.positive_weight, 1.0)
        g, h = (p - y) * w, p * (1 - p) * w
        tree = {}

        def grow(node, rows, level):
            G, H = g[rows].sum(), h[rows].sum()
            best = None
            for f in features(number) if level < params.max_depth else ():
                for cut in range(len(cuts[f])):
                    left = rows[bins[rows, f] <= cut]
                    GL, HL = g[left].sum(), h[left].sum()
                    if HL < params.min_child or H - HL < params.min_child:
                        continue
                    gain = GL**2 / (HL + params.l2) + (G - GL) ** 2 / (H - HL + params.l2) - G**2 / (H + params.l2)
                    if gain > max(params.gamma, 1e-6) and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, cut, left)
            if best is None:
                value = -params.learning_rate * G / (H + params.l2)
                tree[node] = (None, None, value)
                margin[rows] += value
                return
            _, f, cut, left = best
            tree[node] = (COLUMNS[f], cut, 0.0)
            grow(2 * node + 1, left, level + 1)
            grow(2 * node + 2, np.setdiff1d(rows, left), level + 1)

        grow(0, np.arange(len(x)), 0)
        trees.append(tree)
    return margin, trees


@pytest.mark.parametrize(("share", "gamma", "l2", "weight"), [(1.0, 0.0, 1.0, 1.0), (0.5, 1.5, 4.0, 3.0)])
def test_trees_equal_a_plain_booster(spark, share, gamma, l2, weight):
    rows = made()
    params = BoostParams(
        learning_rate=0.3, trees=5, max_depth=3, gamma=gamma, l2=l2, row_share=1.0, feature_share=share,
        positive_weight=weight, bins=16, fold=2,
    )
    training = spark.createDataFrame(rows, ROWS).repartition(5)
    types = [10, 20, 30]
    trees = boosting.train_boosted(training, types, fresh_path(spark, "trees"), params, COLUMNS)
    found = {}
    for r in trees.collect():
        found.setdefault((r["pdm_prod_type_id"], r["tree"]), {})[r["node"]] = (r["feature"], r["cut"], r["value"])
    x = np.array([r[2:] for r in rows])
    cuts = boosting.quantile_cuts(training, COLUMNS, 16)
    scores = {
        (r["pdm_prod_type_id"], r["customer_id"]): r["p"]
        for r in boosting.boosted_scores(training, trees, COLUMNS, nodes_at_once=40).collect()
    }
    for i, t in enumerate(types):
        y = np.array([r[0] == t for r in rows])
        margin, want = plain_booster(
            x, y, cuts, params,
            lambda n, i=i: np.flatnonzero(boosting.chosen_features(params, n, types, len(COLUMNS))[i]),
        )
        for number, tree in enumerate(want):
            got = found[t, number]
            assert got.keys() == tree.keys()
            for node in tree:
                assert got[node][:2] == tree[node][:2] and math.isclose(got[node][2], tree[node][2], abs_tol=1e-7)
        assert np.allclose([scores[t, k] for k in range(len(rows))], 1 / (1 + np.exp(-margin)), atol=1e-6)


def test_runs_are_repeatable_and_go_on(spark):
    params = BoostParams(learning_rate=0.3, trees=4, max_depth=2, bins=8, fold=2)
    training = spark.createDataFrame(made(200), ROWS)
    path = fresh_path(spark, "trees")
    first = boosting.train_boosted(training.coalesce(1), [10, 20], path, params, COLUMNS)
    kept = sorted(map(tuple, first.collect()), key=repr)
    shorter = BoostParams(learning_rate=0.3, trees=2, max_depth=2, bins=8, fold=2)
    other = fresh_path(spark, "trees")
    boosting.train_boosted(training.coalesce(1), [10, 20], other, shorter, COLUMNS)
    more = boosting.train_boosted(training.coalesce(1), [10, 20], other, params, COLUMNS)
    assert sorted(map(tuple, more.collect()), key=repr) == kept
    shares = boosting.boosted_importance(first).groupBy("pdm_prod_type_id").agg(F.sum("importance").alias("s")).collect()
    assert all(math.isclose(r["s"], 1.0) for r in shares)


def test_a_type_without_rows_and_no_cut(spark):
    training = spark.createDataFrame([(10, i, 1.0, 1.0, None, 0.0) for i in range(30)], ROWS)
    params = BoostParams(learning_rate=0.5, trees=2, max_depth=2, row_share=1.0)
    trees = boosting.train_boosted(training, [10, 77], fresh_path(spark, "trees"), params, COLUMNS)
    assert {r["feature"] for r in trees.collect()} == {None} and trees.count() == 6
    scores = {(r["pdm_prod_type_id"]): r["p"] for r in boosting.boosted_scores(training, trees, COLUMNS).collect()}
    assert scores[10] > 0.95 and scores[77] < 0.05
    with pytest.raises(ValueError, match="no types"):
        boosting.train_boosted(training, [], fresh_path(spark, "trees"), params, COLUMNS)


def test_jobs_do_not_grow_with_types(spark):
    """Jobs of a level are the same for two types and for twenty."""
    training = spark.createDataFrame([(i % 20, i, *r[2:]) for i, r in enumerate(made(300))], ROWS)
    params = BoostParams(learning_rate=0.3, trees=1, max_depth=1, bins=8)
    spent = []
    for types in ([0, 1], list(range(20))):
        group = f"boost-{len(types)}"
        spark.sparkContext.setJobGroup(group, group)
        boosting.train_boosted(training, types, fresh_path(spark, "trees"), params, COLUMNS)
        spent.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spent[0] == spent[1]
