"""Writing results: whole tables, and scores one partition per product type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def write_table(
    df: DataFrame,
    table: str,
    if_exists: str = "replace",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Write to a table name or Parquet path and return the written table."""
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}: {if_exists}")
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.mode(MODES[if_exists]).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in table:
        writer.save(table)
        return df.sparkSession.read.parquet(table)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, key: str, partition_by: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Replace a table with one bucketed and sorted by the key later joins use, below `path` if given.

    Rows are gathered by bucket and partition, so a bucket is one file per partition, not one per task; one beyond the
    session's advisory size is split over several tasks and files, so no task sorts more than that. All rows of a key
    share a bucket: choose a key without hot values.
    """
    # The hash that bucketBy deals by.
    dealt = df.withColumn("_dealt_to", F.pmod(F.hash(key), F.lit(buckets)))
    dealt = dealt.hint("rebalance", *[F.col(c) for c in ("_dealt_to", *partition_by)]).drop("_dealt_to")
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


# Fixed value: the folder of rows without a value in the partition column.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def finished_partitions(spark: SparkSession, path: str, column: str) -> list[int | None]:
    """Values of the partition column already written below the path, in order, from the names of its folders; None
    for the rows without a value, at the end."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(place)]
    values = [name.partition("=")[2] for name in names if name.startswith(f"{column}=")]
    return sorted(int(v) for v in values if v != NO_VALUE) + [None] * (NO_VALUE in values)


def checkpoint_scores(scores: DataFrame, path: str, column: str = "pdm_prod_type_id") -> DataFrame:
    """Add the scores of types not yet written, each type in its own partition, and return all of them.

    A rerun after a failure skips the types it finds, and an interrupted write leaves no partition behind:
    Spark moves partitions into place when the whole job commits. Rebalancing gathers the rows of small types
    and splits those of large ones, so files come out at the session's advisory size.
    """
    spark = scores.sparkSession
    done = finished_partitions(spark, path, column)  # at most one value per modelled type
    wanted = F.col(column)
    todo = scores.filter(~F.coalesce(wanted.isin([v for v in done if v is not None]), F.lit(False)))
    if None in done:
        todo = todo.filter(wanted.isNotNull())
    (
        todo.hint("rebalance", F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    written = spark.read.parquet(path)
    return written.select(*[F.col(f.name).cast(f.dataType) for f in scores.schema.fields])
