"""Reading and writing tables."""

import pytest

from basketry.functions.lineage import fresh_path, shared_dir, staged
from basketry.sources import sinks
from basketry.sources.tables import INPUTS, RetailTables, feature_rows, load_table, run_query


def test_write_modes(spark, rows):
    path = fresh_path(spark, "t")
    df = spark.range(3)
    assert sinks.write_table(df, path, "fail").count() == 3
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_table(df, path, "fail")
    assert sinks.write_table(df, path, "append").count() == 6
    assert sinks.write_table(df.filter("id > 0"), path, "replace", sort_by=["id"]).count() == 2
    with pytest.raises(ValueError):
        sinks.write_table(df, path, "truncate")


def test_checkpoint_writes_each_type_once(spark, rows):
    path = fresh_path(spark, "scores")
    schema = "customer_id bigint, p double, pdm_prod_type_id bigint"
    first = spark.createDataFrame([(1, 0.1, 10), (2, 0.2, 10)], schema)
    assert rows(sinks.checkpoint_scores(first, path)) == rows(first)
    # The second run has other scores for type 10, which is finished, and a new type.
    second = spark.createDataFrame([(1, 0.9, 10), (1, 0.3, 20)], schema)
    result = sinks.checkpoint_scores(second, path)
    assert rows(result) == [(1, 0.1, 10), (1, 0.3, 20), (2, 0.2, 10)]
    assert result.schema == first.schema
    assert sinks.finished_partitions(spark, path, "pdm_prod_type_id") == [10, 20]
    assert sinks.finished_partitions(spark, path + "-none", "pdm_prod_type_id") == []


def test_reads(spark, rows):
    path = fresh_path(spark, "t")
    spark.range(10).write.parquet(path)
    assert load_table(spark, path).count() == 10
    assert rows(load_table(spark, path, limit=2, order_by=["id"])) == [(0,), (1,)]
    with pytest.raises(ValueError):
        load_table(spark, path, limit=2)
    assert rows(run_query(spark, "SELECT id FROM {t} WHERE id > :low", {"low": 7}, t=spark.range(10))) == [(8,), (9,)]
    twice = spark.createDataFrame([(1, 2.0, "x"), (1, 2.0, "y")], "customer_id bigint, f double, other string")
    assert rows(feature_rows(twice, ["f"])) == [(1, 2.0)]


def test_inputs_from_a_folder_are_cut_to_known_columns(spark, rows):
    folder = fresh_path(spark, "inputs")
    spark.range(2).selectExpr("id AS trans_id", "id AS customer_id", "1 AS extra").write.parquet(
        f"{folder}/customer_txn_xref"
    )
    tables = RetailTables.from_folder(spark, folder)
    assert tables.customer_txn_xref.columns == list(INPUTS["customer_txn_xref"])
    with pytest.raises(AttributeError):
        tables.nothing


def test_inputs_and_buckets_from_a_database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS inputs LOCATION '{tmp_path}'")
    try:
        df = spark.range(4).selectExpr("id AS trans_id", "id AS customer_id")
        written = sinks.write_bucketed(df, "inputs.customer_txn_xref", 2, "trans_id")
        assert written.count() == 4
        assert sinks.write_table(df, "inputs.plain", "replace").count() == 4
        assert RetailTables.from_database(spark, "inputs").customer_txn_xref.count() == 4
    finally:
        spark.sql("DROP DATABASE inputs CASCADE")


def test_staged_keeps_schema_and_uses_the_shared_folder(spark, rows):
    df = spark.range(3).selectExpr("id", "id % 2 AS k", "array(id) AS a")
    written = staged(df, "s", partition_by=("k",))
    assert rows(written.select(*df.columns)) == rows(df)
    assert written.schema["k"].dataType == df.schema["k"].dataType
    assert all(shared_dir(spark) in f for f in written.inputFiles())


def test_large_buckets_are_written_by_several_tasks(spark, rows, tmp_path):
    def files(df, table, *by):
        sinks.write_bucketed(df, table, 2, "k", by, str(tmp_path / table))
        return sorted((p.parent.name, p.name.split("_")[-1][:5]) for p in (tmp_path / table).rglob("*.parquet"))

    df = spark.range(0, 60000, 1, 8).selectExpr(
        "if(id % 1000 = 7, null, id * 7919 % 30011) AS k", "uuid() AS v", "if(id % 50 = 3, null, id % 2) AS m"
    )
    df = staged(df, "rows")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        # A file per bucket and partition as long as they are small.
        assert files(df, "small_buckets") == [("small_buckets", "00000"), ("small_buckets", "00001")]
        by_month = files(df, "small_months", "m")
        assert len(by_month) == len(set(by_month)) == 6
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
        assert len(files(df, "large_buckets")) >= 6
        written = spark.table("large_buckets")
        assert rows(written, *df.columns) == rows(df)
        # All rows of a key are in one bucket.
        buckets = written.selectExpr("k", "regexp_extract(input_file_name(), '_([0-9]+)[.]c[0-9]+', 1) AS b").distinct()
        assert buckets.count() == buckets.select("k").distinct().count() and buckets.select("b").distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
        for table in ("small_buckets", "small_months", "large_buckets"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
