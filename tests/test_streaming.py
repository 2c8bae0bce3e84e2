"""Streams give what the same functions give on the whole table."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketry.functions.lineage import fresh_path
from basketry.sources.fixtures import RAW, raw, shop_rows
from basketry.streaming import carts
from basketry.streaming import events as streams


@pytest.fixture(scope="module")
def source(spark, folder):
    """The events in four files, in time order, some of them twice."""
    path = fresh_path(spark, "events-in")
    table = raw(spark, folder, "events")
    cuts = table.selectExpr("percentile(unix_micros(cast(ts as timestamp)), array(0.25, 0.5, 0.75)) AS q").first().q
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    for n, (low, high) in enumerate(zip([0, *cuts], [*cuts, 9e18])):
        part = table.filter((micros >= low) & (micros < high))
        again = part.filter("event_id % 10 = 0")
        part.union(again).coalesce(1).write.mode("append").parquet(f"{path}/batch{n}")
    return path


def stream(spark, source):
    return (
        spark.readStream.schema(RAW["events"]).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(source)
    )


def finish(spark, df):
    path, progress = fresh_path(spark, "events-out"), fresh_path(spark, "progress")
    streams.append_to(df, path, progress).awaitTermination()
    return spark.read.schema(df.schema).parquet(path), progress


def test_cleaned_events(spark, folder, source, rows):
    batch = streams.shop_events(shop_rows(raw(spark, folder, "events")))
    cleaned = streams.shop_events(shop_rows(stream(spark, source)), late="30 days")
    written, _ = finish(spark, cleaned)
    assert rows(written) == rows(batch)


def test_sessions_and_hours(spark, folder, source, rows):
    batch = streams.shop_events(shop_rows(raw(spark, folder, "events")))
    live = streams.shop_events(shop_rows(stream(spark, source)), late="1 second")
    # What the watermark has not closed yet is missing at the end; what is there must be the same.
    for make in (lambda e: streams.sessions(e, "2 hours").drop("seen"), streams.hourly_counts):
        expected = rows(make(batch))
        got = rows(finish(spark, make(live))[0])
        assert len(got) > len(expected) * 0.5
        assert set(got) <= set(expected)


def test_abandoned_carts(spark, folder, source, rows):
    batch = streams.shop_events(shop_rows(raw(spark, folder, "events")))
    live = streams.shop_events(shop_rows(stream(spark, source)), late="1 second")
    expected = rows(streams.abandoned_carts(batch))
    got = rows(finish(spark, streams.abandoned_carts(live))[0])
    assert len(got) > len(expected) * 0.5
    assert set(got) <= set(expected)


def test_live_recommendations(spark, folder, source, rows):
    recs = spark.createDataFrame(
        [("South", 5, 50, 1), ("South", 5, 51, 2), ("West", 5, 52, 1)],
        "region string, focus_pdm_prod_type_id bigint, recomm_pdm_prod_type_id bigint, rn bigint",
    )
    batch = streams.shop_events(shop_rows(raw(spark, folder, "events")))
    live = streams.shop_events(shop_rows(stream(spark, source)), late="30 days")
    # Customers of even ids live in the South, the others nowhere known.
    regions = batch.filter("customer_id % 2 = 0").selectExpr("customer_id", "'South' AS region").distinct()
    shown, _ = finish(spark, streams.live_recommendations(live, recs, regions, 1, default="West"))
    expected = streams.live_recommendations(batch, recs, regions, 1, default="West")
    assert rows(shown) == rows(expected)
    assert {(r.customer_id % 2, r.recomm_pdm_prod_type_id) for r in expected.collect()} == {(0, 50), (1, 52)}


def test_cart_recommendations(spark, rows):
    at = dt.datetime(2024, 1, 1)
    done = [(1, 7, "cart_add", 5), (2, 7, "cart_add", 6), (3, 7, "view", 9), (4, 8, "cart_add", 5), (5, 8, "purchase", 5),
            (6, 9, "purchase", 5), (7, 9, "cart_add", 5)]
    events = spark.createDataFrame(
        [(n, at + dt.timedelta(minutes=n), c, k, p) for n, c, k, p in done],
        "event_id bigint, ts timestamp, customer_id bigint, kind string, product_id bigint",
    )
    recs = spark.createDataFrame(
        [("South", 5, 6, 1), ("South", 5, 51, 2), ("South", 6, 51, 3), ("South", 6, 60, 2), ("West", 5, 70, 1)],
        "region string, focus_pdm_prod_type_id bigint, recomm_pdm_prod_type_id bigint, rn bigint",
    )
    regions = spark.createDataFrame([(7, "South"), (8, "South")], "customer_id bigint, region string")
    shown = streams.cart_recommendations(events, recs, regions, 2, default="West")
    # Customer 7 has type 6 in the cart already; 8 bought theirs; 9 put it there again.
    assert rows(shown) == [(7, 51, 2, 2, 1), (7, 60, 2, 1, 2), (9, 70, 1, 1, 1)]


def test_session_pairs(spark, rows):
    at = dt.datetime(2024, 1, 1, 12)
    seen = [
        (1, 0, 7, "view", 1), (2, 1, 7, "click", 1), (3, 5, 7, "purchase", 2),  # one session
        (4, 120, 7, "view", 3), (5, 121, 7, "purchase", 2), (6, 122, 7, "view", 1),  # the next one
        (7, 0, 8, "view", 1), (8, 60, 8, "purchase", 2),  # an hour apart
        (9, 0, 9, "error", 1), (10, 0, 9, "purchase", 2),
    ]
    raw_events = spark.createDataFrame(
        [(n, at + dt.timedelta(minutes=m), u, k, 0.0, f'{{"k": {p}}}') for n, m, u, k, p in seen],
        RAW["events"].replace("timestamp_ntz", "timestamp"),
    )
    sessions = streams.sessions(streams.shop_events(shop_rows(raw_events)))
    assert sessions.count() == 5
    assert rows(streams.session_pairs(sessions)) == [(2, 1, 2), (2, 3, 1)]


def test_any_file_name_and_every_kind(spark):
    made = [(i, dt.datetime(2024, 1, 1, i), 7, kind, 5) for i, kind in enumerate(("view", "click", "cart_add", "purchase", "hover"))]
    schema = "event_id bigint, ts timestamp, customer_id bigint, kind string, product_id bigint"
    path = fresh_path(spark, "landing")
    spark.createDataFrame(made, schema).write.parquet(path)
    written, _ = finish(spark, streams.shop_events(streams.event_stream(spark, path, schema)))
    assert sorted(r.kind for r in written.collect()) == ["cart_add", "click", "purchase", "view"]


def test_session_pairs_of_a_stream(spark, folder, source, rows):
    """Restarted for every file; what has closed equals the batch, also where a product is both bought and seen."""
    batch = streams.shop_events(shop_rows(raw(spark, folder, "events")))
    closed = streams.sessions(batch, "12 hours")
    assert rows(streams.count_session_pairs(streams.session_pair_rows(closed)), "bought", "touched", "n_sessions") == rows(
        streams.session_pairs(closed), "bought", "touched", "n_sessions"
    )
    live = streams.shop_events(shop_rows(stream(spark, source)), late="1 second")
    got = rows(finish(spark, streams.session_pair_rows(streams.sessions(live, "12 hours")))[0])
    expected = rows(streams.session_pair_rows(closed))
    assert set(got) <= set(expected) and len(got) == len(set(got)) > len(expected) * 0.5


CART = "customer_id long, product_id long, kind string, ts timestamp, event_id long"


def cart_events(spark, *events):
    start = dt.datetime(2024, 1, 1)
    rows = [(c, p, kind, start + dt.timedelta(days=day), i) for c, p, kind, day, i in events]
    return spark.createDataFrame(rows, CART)


def test_cart_table_keeps_the_last_event(spark, rows):
    table = carts.CartTable(spark, fresh_path(spark, "carts"), keep="30 days")
    assert table.carts().count() == 0
    first = cart_events(spark, (1, 10, "cart_add", 0, 1), (1, 11, "cart_add", 1, 2), (2, 10, "cart_add", 1, 3), (1, 12, "view", 1, 9))
    second = cart_events(spark, (1, 10, "purchase", 2, 4), (2, 10, "purchase", 0, 5), (3, 7, "cart_add", 20, 6))
    assert table.upsert(first, 0) and table.upsert(second, 1)
    want = [(1, 11), (2, 10), (3, 7)]
    assert rows(table.carts(), "customer_id", "product_id") == want
    # Delivered again: with other rows, after compaction, and where its write was interrupted.
    assert not table.upsert(first.limit(0), 1)
    table.compact()
    assert not table.upsert(second.limit(0), 0) and rows(table.carts(), "customer_id", "product_id") == want
    late = cart_events(spark, (1, 11, "purchase", 1, 1), (1, 10, "cart_add", 40, 8))
    place = f"{table.path}/batch-2"
    late.write.parquet(place)
    (Path(place.removeprefix("file:")) / "_SUCCESS").unlink()
    assert rows(table.carts(), "customer_id", "product_id") == want
    assert table.upsert(late, 2)
    # The late purchase is older than the entry it names; day 40 lets all before day 10 expire.
    assert rows(table.carts(), "customer_id", "product_id") == [(1, 10), (3, 7)]
    table.compact()
    table.compact()
    assert table.last_events().count() == 2


def test_carts_of_a_stream(spark, folder, source, rows):
    batch = streams.shop_events(shop_rows(raw(spark, folder, "events")))
    expected = streams.last_cart_events(batch).filter("kind = 'cart_add'")
    table = carts.CartTable(spark, fresh_path(spark, "carts"), keep=None)
    live = streams.shop_events(shop_rows(stream(spark, source)), late="30 days")
    progress = fresh_path(spark, "progress")
    for _ in range(2):
        carts.keep_carts(live, table, progress).awaitTermination()
        table.compact()
    assert rows(table.carts()) == rows(expected, "customer_id", "product_id", "ts")
