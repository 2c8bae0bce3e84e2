"""What the physical plans must and must not hold."""

import re

import pytest

from basketry.plans import registry

LAZY = (
    "sku_dimension", "base_transactions", "region_of_customer", "regional_ratings", "recommend_types",
    "sku_pairs", "purchase_gaps", "reactivation_base", "reactivation_features", "scoring_features",
    "pivot_scores", "session_pairs", "cart_abandonment",
)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_product_of_rows_and_no_python(spark, folder, name):
    plan = physical(registry.queries()[name](spark, folder))
    assert not re.search(r"CartesianProduct|NestedLoop|Python|ArrowEval|BatchEval", plan)


def test_filters_and_columns_reach_the_scans(spark, folder):
    plan = physical(registry.queries()["base_transactions"](spark, folder))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    lines = next(s for s in scans if "l_orderkey" in s)
    columns = set(re.findall(r"\b(l_\w+)#", lines.split("]")[0]))
    assert columns == {
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
    }
    orders = next(s for s in scans if "o_orderdate" in s)
    assert "GreaterThanOrEqual(o_orderdate" in orders
    assert "IsNotNull(o_orderdate)" in orders


def test_ranks_are_cut_before_the_shuffle(spark, folder):
    plan = physical(registry.queries()["recommend_types"](spark, folder))
    assert "WindowGroupLimit" in plan


def test_only_small_sides_are_broadcast(spark, folder):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("base_transactions", "region_of_customer", "purchase_gaps", "scoring_features", "sku_pairs"):
            assert "BroadcastHashJoin" not in physical(registry.queries()[name](spark, folder)), name
        # The hinted side is the list of modelled types, cut by a limit.
        plan = physical(registry.queries()["reactivation_base"](spark, folder))
        assert plan.count("BroadcastHashJoin") == 1
        assert "TakeOrderedAndProject" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
