"""Windows moved by deltas equal windows counted anew."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry.functions.lineage import fresh_path, staged
from basketry.operators import pairs, purchases, refresh
from basketry.operators.refresh import Move, WindowState
from basketry.params import FactorParams, PairParams, ReactivationParams
from basketry.plans import registry
from basketry.plans.jobs import JobParams, Jobs
from basketry.sources.fixtures import retail_tables

DAY = dt.date(2020, 3, 1)
BASE = "customer_id bigint, transaction_booked_date date, pdm_prod_type_id bigint, item_sku_num bigint, line bigint"


def lines(rng, n, customers=12):
    """Lines of seven months; customer 0 has a third of them."""
    return [
        (0 if rng.random() < 0.35 else rng.randrange(customers), DAY - dt.timedelta(days=rng.randrange(-60, 200)),
         (sku := rng.randrange(18)) % 4, sku, i)
        for i in range(n)
    ]


def reference(spark):
    rows = [(r, f, t, int(f != t)) for r in "ab" for f in range(3) for t in range(4)]
    return spark.createDataFrame(
        rows, "region string, focus_pdm_prod_type_id bigint, recomm_pdm_prod_type_id bigint, product_type_rank bigint"
    )


def region_of(customers):
    """Even customers are in a, those divisible by three in b, the others nowhere."""
    regions = F.filter(
        F.array(F.when(F.col("customer_id") % 2 == 0, "a"), F.when(F.col("customer_id") % 3 == 0, "b")),
        lambda x: x.isNotNull(),
    )
    return customers.select("customer_id", F.explode(regions).alias("region"))


def counted(spark, rows, day, months=2):
    window = Move(day, day, months)
    base = spark.createDataFrame(rows, BASE).filter(
        F.col("transaction_booked_date").between(F.add_months(F.lit(day).cast("date"), -months), F.lit(day))
    )
    base = staged(base, "base")
    items = staged(pairs.basket_items(base), "items")
    regions = staged(region_of(purchases.multi_type_customers(refresh.type_counts(items))), "regions")
    mined = pairs.sku_pairs(base.join(regions, "customer_id"), reference(spark))
    return WindowState(base, items, regions, staged(mined, "pairs")), window


def shown(state, rows):
    return {
        name: rows(df.select(sorted(df.columns))) for name, df in vars(state).items()
    }


@pytest.mark.parametrize("days", [0, 1, 17, 55, 200])
def test_moved_windows_equal_full_runs(spark, rows, days):
    rng = random.Random(days)
    source = lines(rng, 400)
    before = DAY - dt.timedelta(days=60)
    state, _ = counted(spark, source, before)
    after = before + dt.timedelta(days=days)
    move = Move(before, after, 2)
    entering = spark.createDataFrame(source, BASE).filter(move.entering(F.col("transaction_booked_date")))
    moved = refresh.refresh_window(state, entering, move, reference(spark), region_of)
    want, _ = counted(spark, source, after)
    assert shown(moved, rows) == shown(want, rows)


def test_steps_equal_one_move_and_restated_days(spark, rows):
    rng = random.Random(5)
    source = lines(rng, 300)
    before = DAY - dt.timedelta(days=40)
    state, _ = counted(spark, source, before)
    # Lines of a day that the state has are corrected: some go, some are booked late.
    day = before - dt.timedelta(days=3)
    corrected = [r for r in source if r[1] != day] + [(3, day, 1, 1, 9001), (0, day, 2, 6, 9002), (0, day, 2, 6, 9003)]
    for step, restated in ((3, (day,)), (9, ())):
        move = Move(before, before + dt.timedelta(days=step), 2, restated)
        entering = spark.createDataFrame(corrected, BASE).filter(move.entering(F.col("transaction_booked_date")))
        state = refresh.refresh_window(state, entering, move, reference(spark), region_of)
        before = move.after
    want, _ = counted(spark, corrected, before)
    assert shown(state, rows) == shown(want, rows)


def test_a_state_without_what_leaves_is_an_error(spark):
    counts = spark.createDataFrame([(1, 1, 1, 2)], "customer_id long, pdm_prod_type_id long, item_sku_num long, n long")
    delta = counts.withColumn("n", F.lit(-3).cast("long"))
    with pytest.raises(Exception, match="below 0"):
        refresh.with_deltas(counts, delta, "n").collect()
    assert refresh.with_deltas(counts, counts.withColumn("n", F.lit(-2).cast("long")), "n").count() == 0
    with pytest.raises(ValueError, match="forward"):
        Move(DAY, DAY - dt.timedelta(days=1), 6)


def test_heavy_baskets_are_cut_in_deltas(spark, rows):
    rng = random.Random(8)
    before = [("a", c, s % 4, s, 1 + rng.randrange(3)) for c in range(3) for s in range(40)]
    after = [("a", c, s % 4, s, n + (s % 5 == 0)) for _, c, _, s, n in before if s % 7] + [("a", 9, 1, 1, 2), ("a", 9, 2, 2, 1)]
    schema = "region string, customer_id long, pdm_prod_type_id long, item_sku_num long, n long"
    old, new = (staged(spark.createDataFrame(r, schema), "items") for r in (before, after))
    types = pairs.reference_types(reference(spark))
    plain = {k: pairs.pair_counts(d, d, types) for k, d in (("old", old), ("new", new))}
    want = rows(refresh.with_deltas(plain["old"], refresh.pair_deltas(old, new, reference(spark)), "count"))
    assert want == rows(plain["new"])
    cut = pairs.pair_counts(new, new, types, chunk=3)
    assert rows(cut) == want


def explained(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_months_of_the_entering_days():
    rng = random.Random(4)
    for _ in range(300):
        before = dt.date(2019, 1, 1) + dt.timedelta(rng.randrange(900))
        move = Move(before, before + dt.timedelta(rng.choice([0, 1, 20, 70, 400])), rng.randrange(1, 8),
                    tuple(before - dt.timedelta(rng.randrange(99)) for _ in range(rng.randrange(3))))
        days = {move.after - dt.timedelta(n) for n in range((move.after - move.before).days)}
        year, month = divmod(move.after.year * 12 + move.after.month - 1 - move.months, 12)
        kept = {d for d in days if (d.year, d.month) >= (year, month + 1)} | set(move.restated)
        assert move.entering_months() == sorted({d.year * 100 + d.month for d in kept})


def test_only_the_entering_days_are_scanned(spark):
    path = fresh_path(spark, "sales")
    sales = spark.createDataFrame(
        [(i, 1, DAY, 1.0, 1.0, 1) for i in range(3)],
        "transaction_guid long, point_of_sale_item_sku_num long, transaction_booked_date date, gross_sales double, "
        "sold_units double, concept_format_id int",
    )
    sales.write.parquet(path)
    xref = spark.createDataFrame([(0, 1)], "trans_id long, customer_id long")
    customers = spark.createDataFrame([(1, "N")], "customer_id long, customer_purge_ind string")
    skus = spark.createDataFrame(
        [(1, 1, "t", "s", "a", "b", "c", "d")],
        "item_sku_num long, pdm_prod_type_id long, pdm_prod_type_desc string, item_sku_desc string, l1 string, "
        "l2 string, l3 string, l4 string",
    )
    move = Move(DAY - dt.timedelta(days=1), DAY, 6)
    entering = purchases.base_transactions(
        spark.read.parquet(path), xref, customers, skus, PairParams(DAY), move.entering
    )
    assert entering.count() == 1
    scan = next(line for line in explained(entering).split("\n") if "PushedFilters" in line and "booked_date" in line)
    assert f"GreaterThan(transaction_booked_date,{move.before})" in scan
    by_month = fresh_path(spark, "sales-by-month")
    sales.withColumn("booked_month", F.date_format("transaction_booked_date", "yyyyMM").cast("int")).write.partitionBy(
        "booked_month").parquet(by_month)
    stored = purchases.base_transactions(
        spark.read.parquet(by_month), xref, customers, skus, PairParams(DAY), move.entering, move.entering_months()
    )
    assert stored.count() == 1
    read = next(line for line in explained(stored).split("\n") if "PartitionFilters" in line)
    assert "booked_month" in read and "202002" not in read and "202003" in read
    state = spark.read.parquet(path).filter(move.leaving(F.col("transaction_booked_date")))
    assert "LessThan(transaction_booked_date,2019-09-01)" in explained(state)


def test_job_refreshes_an_earlier_run(spark, folder, rows):
    def run(day):
        params = JobParams(
            PairParams(day, rank_limit=10), ReactivationParams(day),
            factors=FactorParams(rank=3, max_iter=2, min_support=2),
        )
        return Jobs(spark, retail_tables(spark, folder), fresh_path(spark, "jobs"), params)

    first = run(registry.PAST)
    first.type_pairs()
    first.sku_pairs()
    second = run(registry.REFRESHED)
    described = second.refresh_sku_pairs(first.out, registry.PAST)
    assert described.columns == spark.read.parquet(f"{first.out}/sku_recommendations").columns
    full = second.flow
    mined = pairs.sku_pairs(
        pairs.tag_regions(full.base_transactions, full.region_of_customer),
        spark.read.parquet(f"{first.out}/type_pair_reference"),
    )
    assert rows(spark.read.parquet(f"{second.out}/sku_pairs").select(mined.columns)) == rows(mined)
    with pytest.raises(ValueError, match="folder of its own"):
        second.refresh_sku_pairs(second.out, registry.PAST)
