"""The forms made for large or skewed data give what the plain forms give."""

import datetime as dt
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.functions.lineage import shared_dir, staged, stages_removed
from basketry.functions.numbering import consecutive, consecutive_within
from basketry.operators import features, pairs
from basketry.operators.reactivation import with_previous_date


def test_stages_are_removed_at_the_end_of_a_run(spark):
    def folders():
        return {n for n in os.listdir(shared_dir(spark)) if n.startswith("removal")}

    kept = staged(spark.range(5), "removal-kept")
    with stages_removed(spark):
        assert staged(spark.range(7), "removal").count() == 7 and len(folders()) == 2
        with pytest.raises(RuntimeError), stages_removed(spark):
            pass
    assert len(folders()) == 1 and kept.count() == 5
    with pytest.raises(ZeroDivisionError), stages_removed(spark):
        staged(spark.range(7), "removal")
        1 / 0  # noqa: B018
    assert len(folders()) == 1


def test_consecutive(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 100003).alias("k")).repartition(7)
    numbered = {r.k: r.n for r in consecutive(df, [F.col("k")], "n").collect()}
    assert numbered == {k: i for i, k in enumerate(sorted(numbered), start=1)}
    assert len(numbered) == 5000


def test_consecutive_within(spark, rows):
    # One group has a third of the rows, one has none but a null key.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
        .alias("g"),
        (F.col("id") * 31 % 17).alias("v"),
        "id",
    )
    order = [F.desc("v"), F.col("id")]
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
    assert rows(consecutive_within(df, ["g"], order, "rn"), "g", "v", "id", "rn") == rows(plain)


def test_previous_date_is_lag(spark, rows):
    rng = random.Random(1)
    data = [
        (0 if rng.random() < 0.34 else rng.randrange(1, 30), dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(40)), n)
        for n in range(2000)
    ]
    df = spark.createDataFrame(data, "c bigint, d date, t bigint")
    plain = df.withColumn("p", F.lag("d").over(Window.partitionBy("c").orderBy("d", "t")))
    assert rows(with_previous_date(df, "c", "d", "t", "p"), "c", "d", "t", "p") == rows(plain)


def brute_pairs(history, reference, key):
    """Ordered pairs of basket positions, the way the result is defined."""
    result = Counter()
    focus_types = {f for f, _ in reference}
    baskets = {}
    for row in history:
        baskets.setdefault(row[key], []).append(row)
    for focus in focus_types:
        wanted = {r for f, r in reference if f == focus}
        for basket in baskets.values():
            kept = [row for row in basket if row["type"] in wanted]
            for a in kept:
                for b in kept:
                    if a["type"] == focus and b["type"] != focus:
                        result[a["sku"], b["sku"]] += 1
    return result


def mined(spark, history, reference, **options):
    df = spark.createDataFrame(
        [("R", r["customer"], r["guid"], r["type"], r["sku"]) for r in history],
        "region string, customer_id bigint, transaction_guid bigint, pdm_prod_type_id bigint, item_sku_num bigint",
    )
    ref = spark.createDataFrame(
        [("R", f, r) for f, r in reference],
        "region string, focus_pdm_prod_type_id bigint, recomm_pdm_prod_type_id bigint",
    )
    return {(r.Focus, r.Recomm): r["count"] for r in pairs.sku_pairs(df, ref, **options).collect()}


@pytest.fixture(scope="module")
def history():
    rng = random.Random(2)
    made = []
    for n in range(900):
        kind = rng.randrange(1, 6)
        # Customer 0 holds a third of all purchases.
        customer = 0 if rng.random() < 0.33 else rng.randrange(1, 40)
        made.append({"customer": customer, "guid": customer * 100 + rng.randrange(5), "type": kind,
                     "sku": kind * 100 + rng.randrange(12)})
    return made


REFERENCE = [(1, 1), (1, 2), (1, 3), (2, 2), (2, 1), (3, 3), (3, 5), (4, 5)]


@pytest.mark.parametrize("chunk", [2000, 5])
def test_sku_pairs(spark, history, chunk):
    # Focus type 4 is not listed for itself, so it has no pair in either form.
    assert mined(spark, history, REFERENCE, chunk=chunk) == brute_pairs(history, REFERENCE, "customer")


def test_sku_pairs_by_transaction(spark, history):
    by_transaction = mined(spark, history, REFERENCE, basket_key="transaction_guid")
    assert by_transaction == brute_pairs(history, REFERENCE, "guid")
    by_customer = mined(spark, history, REFERENCE)
    assert all(by_customer[pair] >= n for pair, n in by_transaction.items())


def test_relabelled_customers(spark, history):
    renamed = [{**row, "customer": 1000 - row["customer"]} for row in history]
    assert mined(spark, history, REFERENCE) == mined(spark, renamed, REFERENCE)


def test_distinct_baskets(spark):
    twice = [{"customer": 1, "guid": 1, "type": t, "sku": t * 100} for t in (1, 1, 2, 2, 2)]
    reference = [(1, 1), (1, 2)]
    assert mined(spark, twice, reference) == {(100, 200): 6}
    assert mined(spark, twice, reference, distinct_baskets=True) == {(100, 200): 1}


@pytest.mark.parametrize("until", [None, 202006])
def test_latest_rows_are_found_without_sorting_the_table(spark, rows, until):
    rng = random.Random(5)
    # Address 0 has a third of the rows; some stop years before the others.
    data = [
        (rng.choice([0, None, *range(1, 40)]) if n % 3 else 0, rng.choice([None, 201801, *range(202001, 202011)]),
         rng.randrange(3), rng.choice(["a", None]))
        for n in range(900)
    ] + [(50, 201512, 1, "b"), (50, 201512, 1, "b"), (50, 201512, 2, "b"), (51, None, 1, "b")]
    table = spark.createDataFrame(data, "address_guid bigint, fiscal_period_id int, v int, s string")
    wanted = [0, *range(10, 30), 50, 51, 77, None]
    addresses = spark.createDataFrame([(a,) for a in wanted + wanted], "address_id bigint")
    known = [r for r in data if r[0] in wanted and None not in r[:2] and (until is None or r[1] <= until)]
    last = {}
    for address, period, *_ in known:
        last[address] = max(period, last.get(address, 0))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = features.latest_rows(table, addresses, until)
        assert rows(latest) == sorted({r for r in known if r[1] == last[r[0]]}, key=repr)
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and not re.search(r"Window|Sort", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
