"""Isotonic calibration of scores, one curve per product type.

Curves are tables of points and never pass through the driver. The fit pools adjacent violators: first within
range-partitioned runs of scores, each task its own run, then over the blocks that are left of a type. Pooling
runs first changes nothing of the whole's result. Outcomes are 0 or 1, so the blocks of n rows are the edges of a
convex polygon on a grid n wide and high, at most about n to the power of 2/3 of them: what one task holds of a
type with a billion rows is in the millions.

The lookup is a sorted merge: rows and points are sorted by type and score together, and each row takes the last
point before it, which also names the next one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.lineage import staged

TYPE = "pdm_prod_type_id"
_BLOCKS = f"{TYPE} bigint, low double, high double, y double, n double"
# A point of a curve and the next one of its type. The first one of a type stands at minus infinity.
_POINT = ("score", "value", "next_score", "next_value")
CURVES = f"{TYPE} bigint, " + ", ".join(f"{c} double" for c in _POINT)


def score_summary(scored: DataFrame) -> DataFrame:
    """Sum of outcomes and row count per type and distinct score; isotonic fits need no more than that.

    Rows without a score or an outcome say nothing.
    """
    known = scored.filter(F.col("p").isNotNull() & ~F.isnan("p") & F.col("y").isNotNull())
    return known.groupBy(TYPE, "p").agg(
        F.sum(F.col("y").cast("double")).alias("y"), F.count(F.lit(1)).cast("double").alias("n")
    )


Block = tuple[float, float, float, float]  # lowest and highest score, sum of outcomes, rows


def pooled(runs: Iterator[tuple[int, Block]]) -> Iterator[tuple[int, list[Block]]]:
    """Blocks in order of type and score, pooled until their means rise, type by type."""
    current, stack = None, []
    for type_id, (low, high, y, n) in runs:
        if type_id != current:
            if stack:
                yield current, stack
            current, stack = type_id, []
        while stack and stack[-1][2] * n >= y * stack[-1][3]:
            first, _, more, rows = stack.pop()
            low, y, n = first, more + y, rows + n
        stack.append((low, high, y, n))
    if stack:
        yield current, stack


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for batch in batches:
        type_id, *block = (c.to_pylist() for c in batch.columns)
        yield from zip(type_id, zip(*block, strict=True), strict=True)


def _pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for type_id, blocks in pooled(_runs(batches)):
        low, high, y, n = (pa.array(c, pa.float64()) for c in zip(*blocks, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array([type_id] * len(low), pa.int64()), low, high, y, n], [TYPE, "low", "high", "y", "n"]
        )


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for type_id, blocks in pooled(_runs(batches)):
        low, high, y, n = (np.array(c) for c in zip(*blocks, strict=True))
        ends = np.stack([low, high], 1).ravel()
        value = np.repeat(y / n, 2)
        kept = np.ones(len(ends), bool)
        kept[1::2] = high > low
        score = np.concatenate(([-np.inf], ends[kept]))
        value = np.concatenate((value[:1], value[kept]))
        following = [np.append(c[1:], c[-1]) for c in (score, value)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(score), type_id)), *map(pa.array, (score, value, *following))], [TYPE, *_POINT]
        )


def fit_calibration(scored: DataFrame, type_ids: Sequence[int] | None = None) -> DataFrame:
    """Fit p to the outcome y per type (of type_ids, if given) and return the points of the curves."""
    if type_ids is not None:
        scored = scored.filter(F.col(TYPE).isin(*type_ids))
    summary = score_summary(scored).select(
        F.col(TYPE).cast("bigint").alias(TYPE), F.col("p").alias("low"), F.col("p").alias("high"), "y", "n"
    )
    parts = summary.repartitionByRange(TYPE, "low").sortWithinPartitions(TYPE, "low").mapInArrow(_pool, _BLOCKS)
    blocks = staged(parts, "calibration-blocks")
    return blocks.repartition(TYPE).sortWithinPartitions(TYPE, "low").mapInArrow(_points, CURVES)


def calibrate_scores(scores: DataFrame, curves: DataFrame, output: str = "calibrated") -> DataFrame:
    """Calibrated score of every row of a type with a curve: linear between the points, constant outside them.
    Rows without a score get none. The output may take the name of a column, which it replaces.

    Rows are dealt out by type, score and a hash of the row, so many rows of one score are many tasks. What a task
    lacks, the last point before its first row, comes from a table of one row per task.
    """
    odd = F.col("p").isNull() | F.isnan("p")
    columns = [f"`{c}`" for c in scores.columns if c != output]
    rows = scores.filter(~odd).select(
        F.col(TYPE).cast("bigint").alias("_type"), F.col("p").cast("double").alias("_at"), F.lit(1).alias("_row"),
        F.xxhash64(*columns).alias("_salt"), F.struct(*columns).alias("_payload"),
        *[F.lit(None).cast("double").alias(f"_{c}") for c in _POINT],
    )
    points = curves.select(
        F.col(TYPE).alias("_type"), F.col("score").alias("_at"), F.lit(0).alias("_row"),
        F.lit(0).cast("bigint").alias("_salt"), F.lit(None).cast(rows.schema["_payload"].dataType).alias("_payload"),
        *[F.col(c).alias(f"_{c}") for c in _POINT],
    )
    order = ["_type", "_at", "_row", "_salt"]
    merged = rows.union(points).repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["_type", "_row", *(f"_{c}" for c in _POINT)]
    places = [merged.columns.index(c) for c in names]

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every row with the last point before it, if its task has one of its type."""
        last_type, last = None, [np.nan] * len(_POINT)
        for batch in batches:
            types, is_row, *point = (batch.column(i).to_numpy(zero_copy_only=False) for i in places)
            at = np.maximum.accumulate(np.where(is_row == 0, np.arange(len(types)), -1))
            found = np.where(at >= 0, types[at] == types, types == last_type)
            columns = list(batch.columns)
            for i, values, before in zip(places[2:], point, last, strict=True):
                taken = np.where(at >= 0, values[at], before)
                columns[i] = pa.array(taken, pa.float64(), mask=~found)
            if len(at) and at[-1] >= 0:
                last_type, last = types[at[-1]], [values[at[-1]] for values in point]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    merged = staged(merged.mapInArrow(filled, merged.schema).withColumn("_task", F.spark_partition_id()), "calibration")
    whole = F.struct("_type", *[F.col(f"_{c}") for c in _POINT])
    lasts = merged.groupBy("_task").agg(F.max_by(F.when(F.col("_row") == 0, whole), F.when(F.col("_row") == 0, F.struct("_type", "_at"))).alias("_end"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    carried = lasts.select("_task", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    given = merged.filter("_row = 1").join(F.broadcast(carried), "_task")
    same = F.col("_carry._type") == F.col("_type")
    score, value, next_score, next_value = (
        F.coalesce(f"_{c}", F.when(same, F.col(f"_carry._{c}"))) for c in _POINT
    )
    slope = (next_value - value) / (next_score - score)
    calibrated = (
        F.when((next_value == value) | (next_score == score), value).otherwise(value + slope * (F.col("_at") - score))
    )
    kept = given.select("_payload.*", calibrated.alias(output)).filter(F.col(output).isNotNull())
    unscored = scores.filter(odd).join(curves.select(TYPE).distinct(), TYPE, "left_semi")
    return kept.unionByName(unscored.withColumn(output, F.lit(None).cast("double")))


def calibration_curve(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and mean outcome per type and equal-width score bin."""
    bin_no = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("bigint")
    return scored.groupBy(TYPE, bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("p").alias("mean_p"),
        F.avg(F.col("y").cast("double")).alias("mean_y"),
    )
