"""Boosted trees of all product types at once.

Features are cut into quantile bins once. One pass over the rows then makes a level of one tree of every type: each
task adds up gradients and hessians by type, node, feature and bin, the sums meet in one aggregation, and the best
cut of every node is chosen where the sums are; a row per node reaches the driver. So the jobs of a level are the
same for one type or for hundreds.

A tree sees a share of the rows and a share of the features, both drawn by hashes. A cut's gain is
L(left) + L(right) - L(node) with L = G^2 / (H + l2); it must be above `gamma`, and each side must have a hessian of
`min_child`. A leaf's value is -G / (H + l2) times the learning rate. Tree 0 is one leaf for all rows: the logarithm
of the type's odds (both counts half a row larger, so they stay finite), which the other trees start from.

Gradients are rounded to steps of 2^-30 before they are added, so sums do not depend on how rows are dealt out.
Margins of finished trees are stored with the rows every `fold` trees; those since are computed from the trees.
A finished tree is written for all types; a rerun of the same run goes on after the last one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from basketry.functions.lineage import complete_folders, staged
from basketry.operators.features import impute_features
from basketry.operators.propensity import GROUP_NODES
from basketry.params import FEATURES

TYPE = "pdm_prod_type_id"
TREES = (
    f"{TYPE} bigint, tree int, node int, feature string, cut int, threshold double, value double, gain double"
)
_STEP = float(1 << 30)
_HISTOGRAM = "type int, node int, feature int, bin int, g double, h double"
LEAF = -1


@dataclass(frozen=True)
class BoostParams:
    """Settings of all types' models."""

    learning_rate: float = 0.01
    trees: int = 1000
    max_depth: int = 5
    gamma: float = 0.0
    l2: float = 1.0
    min_child: float = 1.0
    row_share: float = 0.9
    feature_share: float = 0.6
    positive_weight: float = 1.0
    bins: int = 64
    fold: int = 10
    seed: int = 42

    def __post_init__(self):
        if self.trees <= 0 or self.max_depth <= 0:
            raise ValueError("trees and max_depth must be positive")
        if not 2 <= self.bins <= 256:
            raise ValueError(f"bins must lie between 2 and 256: {self.bins}")
        if not 0 < self.row_share <= 1 or not 0 < self.feature_share <= 1:
            raise ValueError("row_share and feature_share must lie in (0, 1]")


def quantile_cuts(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Ascending cuts of every feature, bins - 1 at most: a value belongs to the first cut that is not below it."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col(f), shares, 100 * bins).alias(f) for f in features]).first()
    highest = rows.agg(*[F.max(f).alias(f) for f in features]).first()
    return [sorted({float(x) for x in found[f] or () if x < highest[f]}) for f in features]


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """Well mixed 64-bit numbers of numbers."""
    x = values.astype(np.uint64) + np.uint64(seed % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def chosen_features(params: BoostParams, tree: int, types: Sequence[int], features: int) -> np.ndarray:
    """types x features: whether a type's tree may cut by the feature."""
    kept = max(1, round(params.feature_share * features))
    ids = np.asarray(types, np.int64).astype(np.uint64)[:, None] * np.uint64(1_000_003) + np.arange(features, dtype=np.uint64)
    rank = _mixed(ids, (params.seed << 32) + 2 * tree).argsort(1).argsort(1)
    return rank < kept


class Forest:
    """Trees of all types as arrays: trees x types x nodes. Children of node k are 2 k + 1 and 2 k + 2."""

    def __init__(self, types: int, depth: int):
        self.shape = (types, (2 << depth) - 1)
        self.feature = np.empty((0, *self.shape), np.int16)
        self.cut = np.empty((0, *self.shape), np.int16)
        self.value = np.empty((0, *self.shape))

    def add(self) -> None:
        self.feature = np.concatenate([self.feature, np.full((1, *self.shape), LEAF, np.int16)])
        self.cut = np.concatenate([self.cut, np.zeros((1, *self.shape), np.int16)])
        self.value = np.concatenate([self.value, np.zeros((1, *self.shape))])

    def nodes(self, tree: int, bins: np.ndarray, levels: int) -> np.ndarray:
        """rows x types: the node that a row has come to after so many levels, or its leaf."""
        every, at = np.arange(self.shape[0]), np.zeros((len(bins), self.shape[0]), np.int64)
        row = np.arange(len(bins))[:, None]
        for _ in range(levels):
            feature = self.feature[tree][every, at]
            right = bins[row, np.maximum(feature, 0)] > self.cut[tree][every, at]
            at = np.where(feature == LEAF, at, 2 * at + 1 + right)
        return at

    def margins(self, bins: np.ndarray, levels: int, before: int) -> np.ndarray:
        """rows x types: what the first `before` trees add up to."""
        total = np.zeros((len(bins), self.shape[0]))
        for tree in range(before):
            total += self.value[tree][np.arange(self.shape[0]), self.nodes(tree, bins, levels)]
        return total


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    """Rows of a binary column as an array."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def binned_rows(rows: DataFrame, types: Sequence[int], features: Sequence[str], cuts: list[list[float]]) -> DataFrame:
    """(row, bins, label, margins) of imputed rows, written once: bins one byte a feature, label the place of the
    row's type in types or -1, margins a double a type."""
    place = {t: i for i, t in enumerate(types)}
    schema = "row bigint, bins binary, label int, margins binary"
    known = rows.select(F.monotonically_increasing_id().alias("row"), F.col(TYPE).cast("bigint").alias(TYPE), *features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = bytes(8 * len(types))
        for batch in batches:
            columns = [batch.column(f).to_numpy(zero_copy_only=False).astype(float) for f in features]
            bins = np.stack([np.searchsorted(c, x) for c, x in zip(cuts, columns, strict=True)], 1).astype(np.uint8)
            labels = [place.get(t, -1) for t in batch.column(TYPE).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), pa.array([b.tobytes() for b in bins], pa.binary()), pa.array(labels, pa.int32()),
                pa.array([nothing] * len(labels), pa.binary()),
            ], ["row", "bins", "label", "margins"])

    return staged(known.mapInArrow(run, schema), "binned-rows")


def _level_sums(table: DataFrame, forest: Forest, level: int, allowed: np.ndarray, widths: list[int],
                params: BoostParams, number: int) -> DataFrame:
    """(type, node, feature, bin, g, h) of the nodes of a level of the newest tree."""
    n_types, n_features = allowed.shape
    shared = table.sparkSession.sparkContext.broadcast((forest, allowed))  # types x nodes x `fold` trees
    newest, first = len(forest.value) - 1, (1 << level) - 1
    nodes, width = 1 << level, max(widths)
    limit = int(params.row_share * (1 << 32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, allowed = shared.value
        sums = np.zeros((n_features, 2, n_types * nodes * width))
        for batch in batches:
            bins = _matrix(batch.column("bins"), np.uint8, n_features)
            margins = _matrix(batch.column("margins"), np.float64, n_types) + forest.margins(bins, params.max_depth, newest)
            label = batch.column("label").to_numpy()
            y = label[:, None] == np.arange(n_types)
            p = 1 / (1 + np.exp(-margins))
            weight = np.where(y, params.positive_weight, 1.0)
            row = batch.column("row").to_numpy()
            seen = (_mixed(row, (params.seed << 32) + 2 * number + 1) >> np.uint64(32)) < limit
            at = forest.nodes(newest, bins, level) - first
            # Leaves of earlier levels have smaller numbers.
            use = (at >= 0) & seen[:, None]
            g = np.where(use, np.rint((p - y) * weight * _STEP), 0.0)
            h = np.where(use, np.rint(p * (1 - p) * weight * _STEP), 0.0)
            start = (np.arange(n_types) * nodes + np.maximum(at, 0)) * width
            for f in np.flatnonzero(allowed.any(0)):
                cell = (start + bins[:, f, None]).ravel()
                sums[f, 0] += np.bincount(cell, g.ravel(), sums.shape[2])
                sums[f, 1] += np.bincount(cell, h.ravel(), sums.shape[2])
        f, cell = np.nonzero(sums.any(1))
        kind, rest = np.divmod(cell, nodes * width)
        node, slot = np.divmod(rest, width)
        kept = allowed[kind, f]
        yield pa.RecordBatch.from_arrays([
            pa.array(x[kept], t) for x, t in (
                (kind, pa.int32()), (node + first, pa.int32()), (f, pa.int32()), (slot, pa.int32()),
                (sums[f, 0, cell], pa.float64()), (sums[f, 1, cell], pa.float64()),
            )
        ], ["type", "node", "feature", "bin", "g", "h"])

    cells = table.select("row", "bins", "label", "margins").mapInArrow(run, _HISTOGRAM)
    # Whole numbers below 2^53 for each task; as decimals they add up in any order.
    summed = cells.groupBy("type", "node", "feature", "bin").agg(
        *[(F.sum(F.col(c).cast("decimal(38,0)")).cast("double") / _STEP).alias(c) for c in ("g", "h")]
    )
    return summed


def best_cuts(sums: DataFrame, params: BoostParams) -> DataFrame:
    """(type, node, g, h, best) of every node: its sums, and its best cut with the sums on the left of it, or null.

    Equal gains go to the first feature, then to the lowest cut.
    """
    whole = Window.partitionBy("type", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    level = sums.select(
        "type", "node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(whole).alias("g"), F.sum("h").over(whole).alias("h"),
    )

    def loss(g, h):
        return g * g / (h + params.l2)

    gr, hr = F.col("g") - F.col("gl"), F.col("h") - F.col("hl")
    gain = loss(F.col("gl"), F.col("hl")) + loss(gr, hr) - loss(F.col("g"), F.col("h"))
    valid = (F.col("hl") >= params.min_child) & (hr >= params.min_child) & (gain > max(params.gamma, 1e-6))
    cut = F.when(valid, F.struct(gain.alias("gain"), F.col("feature"), F.col("bin"), F.col("gl"), F.col("hl")))
    order = F.when(valid, F.struct(F.round(gain, 9), -F.col("feature"), -F.col("bin")))
    return level.groupBy("type", "node").agg(F.max_by(cut, order).alias("best"), F.first("g").alias("g"), F.first("h").alias("h"))


def _folded(table: DataFrame, forest: Forest, features: int, params: BoostParams) -> DataFrame:
    """The rows with the margins of the forest's trees added, written."""
    shared = table.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            bins = _matrix(batch.column("bins"), np.uint8, features)
            margins = _matrix(batch.column("margins"), np.float64, forest.shape[0])
            margins = margins + forest.margins(bins, params.max_depth, len(forest.value))
            columns = list(batch.columns)
            columns[3] = pa.array([m.tobytes() for m in margins], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return staged(table.mapInArrow(run, table.schema), "boosted-rows")


def train_boosted(
    training: DataFrame, type_ids: Sequence[int], folder: str, params: BoostParams = BoostParams(),
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """Trees of one model per type, every row a positive of its own type and a negative of the others, written to
    the folder tree by tree; returns all of them. A folder belongs to one run: its finished trees are not made again.
    """
    spark, types, features = training.sparkSession, list(type_ids), list(features)
    if not types:
        raise ValueError("no types to train")
    rows = impute_features(training.select(TYPE, *features), features)
    rows = staged(rows.select(TYPE, *[F.col(f).cast("double").alias(f) for f in features]), "boosting")
    cuts = quantile_cuts(rows, features, params.bins)
    widths = [len(c) + 1 for c in cuts]
    table = binned_rows(rows, types, features, cuts)
    forest = Forest(len(types), params.max_depth)
    finished = {int(f.rpartition("-")[2]): f for f in complete_folders(spark, f"{folder}/tree-*")}
    place = {t: i for i, t in enumerate(types)}
    for number in range(params.trees + 1):
        forest.add()
        tree = len(forest.value) - 1
        if number in finished:
            for r in spark.read.schema(TREES).parquet(finished[number]).collect():
                i = place[r[TYPE]]
                forest.feature[tree, i, r["node"]] = LEAF if r["feature"] is None else features.index(r["feature"])
                forest.cut[tree, i, r["node"]], forest.value[tree, i, r["node"]] = r["cut"] or 0, r["value"]
        else:
            grown = (
                _grow(table, forest, number, types, cuts, widths, features, params) if number
                else _intercepts(table, forest, types, params)
            )
            schema = spark.createDataFrame([], TREES).schema
            spark.createDataFrame(grown, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/tree-{number}")
        if len(forest.value) == params.fold and number < params.trees:
            table = _folded(table, forest, len(features), params)
            forest = Forest(len(types), params.max_depth)
    return read_trees(spark, folder, params.trees)


def _intercepts(table: DataFrame, forest: Forest, types: list[int], params: BoostParams) -> list[tuple]:
    """Tree 0: the logarithm of each type's odds."""
    counts = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}  # a row per type
    n_rows = sum(counts.values())
    odds = [(counts.get(i, 0) * params.positive_weight + 0.5) / (n_rows - counts.get(i, 0) + 0.5) for i in range(len(types))]
    forest.value[-1, :, 0] = np.log(odds)
    return [(t, 0, 0, None, None, None, float(np.log(x)), None) for t, x in zip(types, odds, strict=True)]


def _grow(table, forest, number, types, cuts, widths, features, params) -> list[tuple]:
    """Grow the newest tree of every type level by level; its nodes as rows of TREES."""
    tree, out = len(forest.value) - 1, {}
    allowed = chosen_features(params, number, types, len(features))

    def leaf(i: int, node: int, g: float, h: float) -> None:
        value = -params.learning_rate * g / (h + params.l2)
        forest.value[tree, i, node] = value
        out[i, node] = (types[i], number, node, None, None, None, value, None)

    for level in range(params.max_depth):
        found = best_cuts(_level_sums(table, forest, level, allowed, widths, params, number), params).collect()
        for r in found:
            i, node, best = r["type"], r["node"], r["best"]
            if level == 0:
                leaf(i, node, r["g"], r["h"])
            if best is None:
                continue
            f = best["feature"]
            forest.feature[tree, i, node], forest.cut[tree, i, node] = f, best["bin"]
            forest.value[tree, i, node] = 0.0
            out[i, node] = (types[i], number, node, features[f], best["bin"], cuts[f][best["bin"]], 0.0, best["gain"])
            leaf(i, 2 * node + 1, best["gl"], best["hl"])
            leaf(i, 2 * node + 2, r["g"] - best["gl"], r["h"] - best["hl"])
        if not any(r["best"] for r in found):
            break
    return [out[k] for k in sorted(out)]


def read_trees(spark: SparkSession, folder: str, trees: int) -> DataFrame:
    """Tree 0 and the first trees of a folder."""
    found = {int(f.rpartition("-")[2]): f for f in complete_folders(spark, f"{folder}/tree-*")}
    return spark.read.schema(TREES).parquet(*[found[n] for n in range(trees + 1)])


def type_groups(trees: DataFrame, nodes_at_once: int = GROUP_NODES) -> list[list[int]]:
    """The types of the trees in groups to score together: as many as stay below nodes_at_once nodes, at least one."""
    groups, held = [], nodes_at_once
    for r in trees.groupBy(TYPE).agg(F.count(F.lit(1)).alias("n")).orderBy(TYPE).collect():
        if held + r["n"] > nodes_at_once:
            groups.append([])
            held = 0
        groups[-1].append(r[TYPE])
        held += r["n"]
    return groups


def boosted_scores(
    customers: DataFrame, trees: DataFrame, features: Sequence[str] = FEATURES, key: str = "customer_id",
    nodes_at_once: int = GROUP_NODES, keep: Sequence[str] = (),
) -> DataFrame:
    """(key, kept columns, p, type): probability per customer and type. Types are scored in groups whose trees fit
    into a task."""
    spark, features = customers.sparkSession, list(features)
    groups = type_groups(trees, nodes_at_once)
    if not groups:
        raise ValueError("no model to score with: train first")
    out = [key, *keep]
    rows = impute_features(customers.select(*out, *features), features)
    rows = staged(rows.select(*out, *[F.col(f).cast("double").alias(f) for f in features]), "boosted-customers")
    schema = StructType([*(rows.schema[c] for c in out), StructField("p", DoubleType()), StructField(TYPE, LongType())])
    scored = None
    for group in groups:
        by_type: dict[int, dict[int, dict]] = {t: {} for t in group}
        for r in trees.filter(F.col(TYPE).isin(*group)).collect():
            by_type[r[TYPE]].setdefault(r["tree"], {})[r["node"]] = (r["feature"], r["threshold"], r["value"])
        shared = spark.sparkContext.broadcast(by_type)  # at most nodes_at_once nodes, or one type's

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = {f: batch.column(f).to_numpy(zero_copy_only=False) for f in features}
                for type_id, some in shared.value.items():
                    margin = np.zeros(batch.num_rows)
                    for nodes in some.values():
                        _add_tree(nodes, 0, columns, np.arange(batch.num_rows), margin)
                    p = 1 / (1 + np.exp(-margin))
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c) for c in out), pa.array(p), pa.array(np.full(len(p), type_id))],
                        [*out, "p", TYPE],
                    )

        part = rows.mapInArrow(run, schema)
        scored = part if scored is None else scored.union(part)
    return scored


def _add_tree(nodes: dict, node: int, columns: dict, rows: np.ndarray, margin: np.ndarray) -> None:
    """Add the values of the leaves that the rows come to."""
    feature, threshold, value = nodes[node]
    if feature is None:
        margin[rows] += value
        return
    right = columns[feature][rows] > threshold
    for child, some in ((2 * node + 1, rows[~right]), (2 * node + 2, rows[right])):
        if len(some):
            _add_tree(nodes, child, columns, some, margin)


def boosted_importance(trees: DataFrame) -> DataFrame:
    """Type, feature and the share of its cuts in the gain of all cuts of the type."""
    gains = trees.filter(F.col("feature").isNotNull()).groupBy(TYPE, "feature").agg(F.sum("gain").alias("gain"))
    share = F.col("gain") / F.sum("gain").over(Window.partitionBy(TYPE))
    return gains.select(TYPE, "feature", share.alias("importance"))
