"""Odd inputs, on small hand-made frames."""

import datetime as dt

import pytest

from basketry.functions.expressions import fiscal_period, region_of
from basketry.operators import catalog, features, purchases, ranking, ratings, reactivation, regions
from basketry.params import REGION_CODES, PairParams, ReactivationParams
from pyspark.sql import functions as F

AS_OF = dt.date(2022, 8, 31)
DAY = dt.date(2022, 8, 1)
PAIRS = PairParams(AS_OF)
RETURNS = ReactivationParams(AS_OF)


def skus(spark):
    items = spark.createDataFrame(
        [(1, 10, "a", 1), (2, 20, "b", 1), (3, 0, "c", 1), (4, 30, "d", 1), (5, 40, "e", 1), (6, 10, "f", 1)],
        "item_sku_num bigint, pdm_prod_type_id bigint, item_sku_desc string, class_id bigint",
    )
    types = spark.createDataFrame(
        [(10, "TEN"), (20, "TWENTY"), (0, "ZERO"), (30, "UNKNOWN"), (40, None)],
        "pdm_prod_type_id bigint, pdm_prod_type_desc string",
    )
    levels = spark.createDataFrame(
        [(n, "x", "y", "z", "w") for n in (1, 2, 3, 4, 5)],
        "item_sku_num bigint, l1 string, l2 string, l3 string, l4 string",
    )
    return items, types, levels


def test_dimension_drops_invalid_types_and_skus_without_levels(spark, rows):
    assert rows(catalog.sku_dimension(*skus(spark)), "item_sku_num") == [(1,), (2,)]


def lines(spark, *data):
    return spark.createDataFrame(
        list(data),
        "transaction_guid bigint, point_of_sale_item_sku_num bigint, transaction_booked_date date, "
        "gross_sales double, sold_units double, concept_format_id bigint",
    )


def base(spark, sales):
    xref = spark.createDataFrame([(100, 7), (101, 0), (102, 8), (103, 9)], "trans_id bigint, customer_id bigint")
    customers = spark.createDataFrame(
        [(7, "N", 1), (0, "N", 1), (8, "Y", 1), (9, "N", 1)],
        "customer_id bigint, customer_purge_ind string, address_id bigint",
    )
    return purchases.base_transactions(sales, xref, customers, catalog.sku_dimension(*skus(spark)), PAIRS)


def test_base_transactions(spark, rows):
    sales = lines(
        spark,
        (100, 1, DAY, 10.0, 2.0, 1),
        (100, 1, DAY, 10.0, 2.0, 1),  # same line again
        (100, 1, DAY, 12.0, 2.0, 1),  # another price counts as another line
        (100, 2, DAY, 10.0, 0.0, 1),  # no unit sold
        (101, 1, DAY, 10.0, 1.0, 1),  # customer 0
        (102, 1, DAY, 10.0, 1.0, 1),  # purged
        (103, 1, DAY, 10.0, 1.0, 2),  # other concept
        (103, 4, DAY, 10.0, 1.0, 1),  # unknown type
        (103, 1, dt.date(2022, 2, 28), 10.0, 1.0, 1),  # first day of the window: month end is clamped
        (103, 1, dt.date(2022, 2, 27), 10.0, 1.0, 1),  # the day before
        (103, 1, dt.date(2022, 9, 1), 10.0, 1.0, 1),  # after the window
    )
    result = base(spark, sales)
    assert rows(result, "customer_id", "item_sku_num", "sku_price") == [
        (7, 1, 5.0), (7, 1, 6.0), (7, 2, None), (9, 1, 10.0),
    ]
    counts = purchases.customer_type_counts(result)
    assert rows(counts) == [(7, 10, 2), (7, 20, 1), (9, 10, 1)]
    assert rows(purchases.multi_type_customers(counts)) == [(7, 2)]
    assert rows(purchases.supported_types(counts, 2), "customer_id") == [(7,), (9,)]
    # Support is counted in customers: seed rows and repeated regions don't lift type 20.
    ratings = counts.union(counts).union(spark.createDataFrame([(-1, 20, 1)], counts.schema))
    assert rows(purchases.supported_ratings(ratings, counts, 2), "pdm_prod_type_id") == [(10,)] * 4


def test_doubling_lines_changes_nothing(spark, rows):
    sales = lines(spark, (100, 1, DAY, 10.0, 2.0, 1), (103, 2, DAY, 1.0, 1.0, 1))
    assert rows(base(spark, sales)) == rows(base(spark, sales.union(sales)))


def test_regions(spark, rows):
    codes = spark.createDataFrame(
        [("OH",), (" oh ",), ("ct",), ("MA",), ("Nj",), (None,), ("",), ("TX",), ("hi",)], "c string"
    )
    found = codes.select(region_of(F.col("c"), REGION_CODES, "UNKNOWN").alias("r")).collect()
    assert [r.r for r in found] == [
        "Midwest", "Midwest", "UNKNOWN", "UNKNOWN", "Northeast", "UNKNOWN", "UNKNOWN", "South", "West",
    ]
    assert sum(len(codes) for codes in REGION_CODES.values()) == 49


def test_two_preferred_addresses_give_two_regions(spark, rows):
    result = regions.region_of_customer(
        spark.createDataFrame([(1,), (2,), (3,)], "customer_id bigint"),
        spark.createDataFrame(
            [(1, 11, "Y"), (1, 12, "Y"), (2, 11, "N"), (3, 13, "Y"), (4, 11, "Y")],
            "customer_id bigint, address_id bigint, prefd_cust_ind string",
        ),
        spark.createDataFrame([(11, 21), (12, 22)], "address_id bigint, mailing_address_id bigint"),
        spark.createDataFrame([(21, "OH"), (22, "CA")], "mailing_address_id bigint, territory_cd string"),
        PAIRS,
    )
    assert rows(result) == [(1, "Midwest"), (1, "West"), (2, "UNKNOWN"), (3, "UNKNOWN")]


def test_seed_ids_are_negative_and_in_every_region(spark, rows):
    counts = spark.createDataFrame(
        [(1, 30, 2), (1, 10, 1), (5, 20, 1)], "customer_id bigint, pdm_prod_type_id bigint, trans_count bigint"
    )
    ids = ratings.surrogate_ids(counts)
    assert rows(ids, "pdm_prod_type_id", "seed_id") == [(10, 1), (20, 2), (30, 3)]
    region = spark.createDataFrame([(1, "A"), (1, "B")], "customer_id bigint, region string")
    result = ratings.regional_ratings(counts, region, ratings.item_seed_rows(ids), ["A", "B"])
    assert rows(result.filter("customer_id < 0")) == sorted(
        [(r, -n, t, 1) for r in "AB" for n, t in ((1, 10), (2, 20), (3, 30))], key=repr
    )
    assert rows(result.filter("customer_id > 0"), "region", "pdm_prod_type_id") == [
        ("A", 10), ("A", 30), ("B", 10), ("B", 30),
    ]


def test_rank_limit_counts_the_focus_type(spark, rows):
    scores = spark.createDataFrame(
        [("R", -1, 10, 0.9), ("R", -1, 20, 0.8), ("R", -1, 30, 0.8), ("R", -1, 40, 0.1),
         ("R", -2, 20, 0.1), ("R", -2, 10, 0.9), ("R", -2, 30, 0.8), ("R", -2, 40, 0.7)],
        "region string, customer_id bigint, pdm_prod_type_id bigint, confidence double",
    )
    seeds = spark.createDataFrame([(-1, 10, 1), (-2, 20, 1)],
                                  "customer_id bigint, pdm_prod_type_id bigint, trans_count bigint")
    types = spark.createDataFrame([(t, f"T{t}") for t in (10, 20, 30, 40)],
                                  "pdm_prod_type_id bigint, pdm_prod_type_desc string")
    recs = ranking.recommend_types(ranking.rank_candidates(scores), seeds, types, rank_limit=3)
    # Type 10 ranks first for itself and leaves two; type 20 is beyond the limit and leaves three.
    assert rows(recs, "focus_pdm_prod_type_id", "recomm_pdm_prod_type_id", "rn") == [
        (10, 20, 1), (10, 30, 2), (20, 10, 1), (20, 30, 2), (20, 40, 3),
    ]
    flat = ranking.flatten_candidates(ranking.candidate_lists(scores))
    assert rows(flat) == rows(ranking.rank_candidates(scores))
    best = ranking.get_recommendations(recs, 20, "R", 2).collect()
    assert [r.recomm_pdm_prod_type_id for r in best] == [10, 30]
    reference = ranking.type_pair_reference(recs, max_rank=1)
    assert rows(reference, "focus_pdm_prod_type_id", "product_type_rank", "recomm_pdm_prod_type_id") == [
        (10, 0, 10), (10, 1, 20), (20, 0, 20), (20, 1, 10),
    ]
    ranked_skus = recs.withColumn("sku_rank", F.col("rn"))
    assert ranking.type_pair_reference(ranked_skus, 4).filter("product_type_rank > 0").count() == 2
    bought = spark.createDataFrame([(-1, 20)], "customer_id bigint, pdm_prod_type_id bigint")
    assert rows(ranking.without_bought(scores.filter("customer_id = -1"), bought), "pdm_prod_type_id") == [
        (10,), (30,), (40,),
    ]


def test_fiscal_period_clamps_to_month_end(spark):
    days = spark.createDataFrame(
        [(dt.date(2020, 5, 31),), (dt.date(2020, 1, 15),), (None,)], "d date"
    ).select(fiscal_period(F.col("d")).alias("p")).collect()
    assert [r.p for r in days] == [202002, 201910, None]


def test_top_types_null_and_skip(spark, rows):
    bought = spark.createDataFrame(
        [(1, None), (2, None), (3, None), (1, 10), (2, 10), (1, 20)],
        "customer_guid bigint, pdm_prod_type_id bigint",
    )
    assert rows(reactivation.top_reactivation_types(bought, 2), "pdm_prod_type_id") == [(10,), (None,)]
    assert rows(reactivation.top_reactivation_types(bought, 2, keep_null=False), "pdm_prod_type_id") == [
        (10,), (20,),
    ]
    assert rows(reactivation.top_reactivation_types(bought, 3, skip=1), "pdm_prod_type_id") == [(10,), (20,)]


def test_gap_limits(spark, rows):
    day = dt.date(2022, 6, 1)
    bought = spark.createDataFrame(
        [(c, 1, c, day, 5, 10, "s", "T") for c in range(1, 7)],
        "customer_guid bigint, address_id bigint, transaction_guid bigint, transaction_booked_date date, "
        "point_of_sale_item_sku_num bigint, pdm_prod_type_id bigint, item_sku_desc string, "
        "pdm_prod_type_desc string",
    )
    gaps = spark.createDataFrame(
        [(c, c, day, day - dt.timedelta(days=g) if g is not None else None, 1, 1, g)
         for c, g in ((1, 364), (2, 365), (3, 720), (4, 721), (5, 0), (6, None))],
        "customer_id bigint, transaction_guid bigint, reactivation_purchase date, previous_buy date, "
        "FP int, FP2 int, time_interval bigint",
    )
    assert rows(reactivation.reactivation_base(bought, gaps, RETURNS), "customer_id") == [(2,), (3,)]
    late = ReactivationParams(AS_OF, earliest_previous=dt.date(2021, 1, 1))
    assert rows(reactivation.reactivation_base(bought, gaps, late), "customer_id") == [(2,)]


def test_valid_addresses(spark, rows):
    customers = spark.createDataFrame(
        [(1, "N", 5), (2, "Y", 5), (0, "N", 5), (3, "N", 0)],
        "customer_id bigint, customer_purge_ind string, address_id bigint",
    )
    assert rows(reactivation.valid_addresses(customers)) == [(1, 5)]


def test_life_stage_flags(spark, rows):
    date = dt.date(2022, 6, 1)
    base = spark.createDataFrame([(c, date) for c in range(1, 7)], "customer_id bigint, d date")
    history = spark.createDataFrame(
        [
            (1, "NEW MOVER", date + dt.timedelta(days=60)),  # first covered day
            (2, "NEW MOVER", date + dt.timedelta(days=61)),
            (3, "NEW MOVER", date - dt.timedelta(days=300)),  # last covered day
            (4, "NEW MOVER", date), (4, "BABY", date),  # two events on the last date
            (5, "NEW MOVER", date), (5, "GRADUATION", date + dt.timedelta(days=1)),  # later event hides it
        ],
        "customer_guid bigint, lifestage_event string, lifestage_date date",
    )
    flags = features.life_stage_flags(base, history, "d")
    assert rows(flags, "customer_id", "MOVER", "BABY") == [
        (1, 1, 0), (2, 0, 0), (3, 1, 0), (4, 1, 1), (5, 0, 0), (6, 0, 0),
    ]


def test_latest_rows_keep_ties_once(spark, rows):
    table = spark.createDataFrame(
        [(1, 202201, 1.0), (1, 202203, 2.0), (1, 202203, 3.0), (1, 202203, 3.0), (2, 202101, 9.0), (3, 1, 0.0)],
        "address_guid bigint, fiscal_period_id int, v double",
    )
    wanted = spark.createDataFrame([(1,), (2,)], "address_id bigint")
    assert rows(features.latest_rows(table, wanted), "address_guid", "v") == [(1, 2.0), (1, 3.0), (2, 9.0)]


def test_imputation(spark):
    df = spark.createDataFrame(
        [("n/a", None, None, 3.0, None), ("4", 1.0, 2.0, float("nan"), None)],
        "A_AAP000447N_ASET_PRPN_DIS_INC string, BBB_INSTORE_M_DECILE_2Y double, BBB_R_2Y double, "
        "PH_DM_RECENCY double, MOVER int",
    )
    filled = features.impute_features(df, df.columns).collect()
    assert [tuple(r) for r in filled] == [(0.0, 11.0, 720.0, 3.0, 0.0), (4.0, 1.0, 2.0, 365.0, 0.0)]
    # The first rule wins, and names match in any case.
    assert features.fill_value("recency_decile") == 11.0


@pytest.mark.parametrize("change", [
    {"learning_rate": 0}, {"learning_rate": 1}, {"trees": 0}, {"parallelism": 0}, {"train_share": 0},
    {"calibration": "sigmoid"},
])
def test_parameter_ranges(change):
    from basketry.params import TreeParams

    with pytest.raises(ValueError):
        TreeParams(**change)
