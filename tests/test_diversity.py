"""Diversity of lists, stored sales, the number of clusters."""

import math
import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from basketry.functions.lineage import fresh_path
from basketry.operators import diversity, segments
from basketry.params import ClusterParams
from basketry.plans import registry
from basketry.sources import sinks, storage


def test_list_distances_and_exposure_by_brute_force(spark):
    rng = random.Random(4)
    paths = {t: (rng.choice("ab"), rng.choice("cd"), rng.choice("ef")) for t in range(1, 13)}
    known = {t: p for t, p in paths.items() if t != 12}  # type 12 has no path
    recs = [(r, f, t, n) for r in ("x", "y") for f in range(1, 9)
            for n, t in enumerate(rng.sample(range(1, 13), rng.randrange(1, 9)), 1)]
    recs += recs[:5] + [("z", 1, 3, 1), ("z", 1, 4, None)]
    frame = spark.createDataFrame(recs, "region string, focus_pdm_prod_type_id bigint, recomm_pdm_prod_type_id bigint, rn bigint")
    catalog = spark.createDataFrame([(t, *p) for t, p in known.items()], "pdm_prod_type_id bigint, l1 string, l2 string, l3 string")

    def apart(a, b):
        same = 0
        for x, y in zip(known.get(a, ()), known.get(b, ()), strict=False):
            if x != y:
                break
            same += 1
        return 1 - same / 3

    lists = {}
    for region, focus, t, n in recs:
        if n is not None and n <= 5:
            lists.setdefault((region, focus), set()).add(t)
    got = {(r["region"], r["focus_pdm_prod_type_id"]): (r["n_types"], r["distance"])
           for r in diversity.list_diversity(frame, catalog, 5).collect()}
    assert got.keys() == lists.keys()
    for key, types in lists.items():
        pairs = [apart(a, b) for a, b in combinations(sorted(types), 2)]
        assert got[key][0] == len(types)
        assert got[key][1] == (pytest.approx(sum(pairs) / len(pairs)) if pairs else None)

    gini = {r["region"]: r["gini"] for r in diversity.exposure_gini(frame, catalog, 5).collect()}
    for region in ("x", "y", "z"):
        counts = [sum(t in types for (r, _), types in lists.items() if r == region) for t in known]
        total = sum(abs(a - b) for a in counts for b in counts) / (2 * len(counts) * sum(counts))
        assert gini[region] == pytest.approx(total)
    assert diversity.region_diversity(frame.where("false"), catalog.withColumn("item_sku_num", F.lit(1)), 5).count() == 0


def test_path_is_that_of_most_skus(spark, rows):
    skus = spark.createDataFrame(
        [(1, 7, "a", "x", None), (2, 7, "a", "y", "s"), (3, 7, "b", "x", "s"), (4, 8, "c", "z", "t"), (4, 8, "c", "z", "t"),
         (5, 8, "d", "z", "t")], "item_sku_num bigint, pdm_prod_type_id bigint, l1 string, l2 string, l3 string")
    assert rows(diversity.type_paths(skus)) == [(7, "a", "x", None), (8, "c", "z", "t")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_sales_join_without_exchange_and_read_their_months(spark, folder):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with registry.stored_sales(spark, folder) as (lines, xref):
            owned = storage.owned_lines(lines, xref, registry.season_months(lines))
            plan = plan_of(owned)
            assert "SortMergeJoin" in plan and "dynamicpruning" in plan
            # Only the months are moved.
            assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) <= {storage.MONTH}
            window = registry.stored_base(spark, folder, lines, xref)
            scan = next(s for s in plan_of(window).splitlines() if "FileScan" in s and "sold_units" in s)
            assert "PartitionFilters: [isnotnull(booked_month" in scan
            owners = [s for s in plan_of(window).splitlines() if "Exchange hashpartitioning(transaction_guid" in s]
            assert not owners
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("sales_line_")]


def test_scores_without_a_type_can_be_resumed(spark, rows):
    path, schema = fresh_path(spark, "scores"), "customer_id bigint, p double, pdm_prod_type_id bigint"
    first = spark.createDataFrame([(1, 0.1, 10), (2, 0.2, None)], schema)
    sinks.checkpoint_scores(first, path)
    assert sinks.finished_partitions(spark, path, "pdm_prod_type_id") == [10, None]
    again = spark.createDataFrame([(1, 0.9, 10), (2, 0.9, None), (3, 0.3, 30)], schema)
    assert rows(sinks.checkpoint_scores(again, path)) == [(1, 0.1, 10), (2, 0.2, None), (3, 0.3, 30)]


@pytest.mark.parametrize("planted", [3, 5, 8])
def test_number_of_clusters_is_found(spark, planted):
    rng = random.Random(planted)
    data = [
        (n, *[10 * math.cos(2 * math.pi * (n % planted) / planted + s) + rng.gauss(0, 0.3) for s in (0, math.pi / 2)])
        for n in range(80 * planted)
    ]
    wide = spark.createDataFrame(data, "customer_id bigint, p1 double, p2 double")
    params = ClusterParams(candidates=tuple(range(2, 11)), starts=3)
    assert len(segments.fit_clusters(wide, params).stages[-1].clusterCenters()) == planted
    same = spark.createDataFrame([(n, 1.0, 1.0) for n in range(9)], wide.schema)
    assert len(segments.fit_clusters(same, ClusterParams(candidates=(2, 3))).stages[-1].clusterCenters()) >= 1
    with pytest.raises(ValueError):
        ClusterParams(candidates=(1, 2))
