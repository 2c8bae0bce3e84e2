"""What the operators share: tables, Arrow passes over whole partitions, words."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# White space of the word rule [^\x20\x09-\x0D]+, as a Java character class.
SPACE = "[\\x20\\x09-\\x0D]"
DOCUMENTS = StructType([StructField("text", StringType())])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores added until the frame has no such column (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def beside(
    df: DataFrame, ours: Sequence[str], compute: Callable[[DataFrame], DataFrame], inner: Sequence[str] = ()
) -> DataFrame:
    """The columns of df as they are and, behind them, the columns `ours` that compute(df) adds.

    compute sees columns of df that have such a name, or one of `inner`, under another one; ours get underscores then.
    """
    names = {name.lower() for name in (*ours, *inner)}
    away, renamed = {}, df
    for column in df.columns:
        if column.lower() in names:
            away[column] = free_name(renamed, f"_own_{column}")
            renamed = renamed.withColumnRenamed(column, away[column])
    out = [F.col(f"`{away.get(c, c)}`").alias(c) for c in df.columns]
    made = compute(renamed)
    taken = df
    for name in ours:
        free = free_name(taken, name)
        taken = taken.withColumn(free, F.lit(None))
        out.append(F.col(name).alias(free))
    return made.select(*out)


def map_batches(df: DataFrame, step: Callable[[pa.RecordBatch], dict | None], schema: StructType) -> DataFrame:
    """Apply step to every Arrow batch; step returns the columns of the output rows, or None for no rows."""
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = step(batch)
            if found is not None:
                yield pa.RecordBatch.from_arrays([as_array(found[n]) for n in names], names)

    return df.mapInArrow(run, schema)


def as_array(values) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        return values.combine_chunks()
    return values if isinstance(values, pa.Array) else pa.array(values)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def spaced(text: Column) -> Column:
    """Words of a text as an array; no words for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
