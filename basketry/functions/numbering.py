"""Consecutive numbers over tables too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.lineage import staged

# monotonically_increasing_id keeps the row within its partition in the low 33 bits.
_ROW_BITS = 33


def consecutive(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number all rows 1..N in the given order, which must be total.

    The rows are range-partitioned and sorted, numbered within their partition, and shifted by the number
    of rows in earlier partitions. Only the per-partition row counts leave the executors.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    slots = staged(ordered.withColumn("_slot", F.monotonically_increasing_id()), "numbering")
    part = F.shiftright("_slot", _ROW_BITS)
    sizes = slots.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    # One row per partition, so the planner sees how small this side is.
    shifts, earlier = [(-1, 0)], 0
    for size in sorted(sizes, key=lambda r: r["part"]):
        shifts.append((size["part"], earlier))
        earlier += size["n"]
    starts = df.sparkSession.createDataFrame(shifts, "_part bigint, _shift bigint")
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        slots.withColumn("_part", part)
        .join(starts, "_part")
        .withColumn(name, (F.col("_shift") + row + 1).cast("bigint"))
        .drop("_part", "_slot", "_shift")
    )


def consecutive_within(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """row_number per group for groups of any size: number everything, subtract each group's start."""
    numbered = consecutive(df, [*(F.col(g) for g in groups), *order], "_n")
    starts = staged(
        numbered.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]).agg(
            F.min("_n").alias("_start")
        ),
        "group_starts",
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    return (
        numbered.join(starts, same)
        .withColumn(name, F.col("_n") - F.col("_start") + 1)
        .drop("_n", "_start", *[f"_g{i}" for i in range(len(groups))])
    )
