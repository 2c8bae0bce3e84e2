"""SimHash near-duplicates: 64-bit fingerprints, BK-trees per shard, links joined into components.

Distinct fingerprints are sharded so that every pair within the radius meets: the bits are cut into radius + 2
blocks, of which such a pair shares at least two, and each pair of blocks with its values is a shard. A shard's
fingerprints go into a BK-tree: children hang at their integer Hamming distance to the parent, and a search
follows only the edges that the triangle inequality leaves within the radius. A shard that has more members
than one tree may hold is dealt to several trees, and each of its members visits every tree once, in as many
tasks; so no task holds more than one bounded tree and no link is lost. A tree reports only the links that
join two of its own components, never all pairs.

Fewer words than a shingle: the words there are make the one shingle. No words (null, empty, blank): fingerprint
zero, which links like any other. Repeated rows have one fingerprint; an empty table gives no rows; a null
doc_id counts only if its whole component has no other.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from basketry.functions.lineage import staged
from basketry.llm.common import free_name, read_table
from basketry.llm.components import connected_components

SHINGLE, RADIUS, SEED, TREE = 3, 3, 42, 4096
_HASHED = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the shingles' hashes, as a signed 64-bit number."""
    words = text.lower().split() if text else ()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(b" ".join(x), SEED) for x in zip(*(words[i:] for i in range(shingle)), strict=False)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _HASHED):
        some = np.array(hashes[at:at + _HASHED], "<u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = 2 * counts > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """The rows with the fingerprint of their whole text."""
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            prints = pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], schema.fieldNames())

    return docs.mapInArrow(run, schema)


class BKTree:
    """Fingerprints; each child hangs below its parent at their distance."""

    def __init__(self):
        self.prints: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.prints.append(value)
        self.children.append({})
        if len(self.prints) == 1:
            return
        at = 0
        while True:
            apart = (self.prints[at] ^ value).bit_count()
            below = self.children[at].get(apart)
            if below is None:
                self.children[at][apart] = len(self.prints) - 1
                return
            at = below

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of the members at most radius bits away."""
        found, open_ = [], [0] if self.prints else []
        while open_:
            at = open_.pop()
            apart = (self.prints[at] ^ value).bit_count()
            if apart <= radius:
                found.append(at)
            for edge, below in self.children[at].items():
                if apart - radius <= edge <= apart + radius:
                    open_.append(below)
        return found


def shard_keys(value: Column, radius: int) -> Column:
    """The shards of a fingerprint, as numbers: one for each pair of radius + 2 blocks of its bits."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [
        (F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1)), high - low)
        for low, high in zip(edges[:-1], edges[1:], strict=True)
    ]
    keys = []
    for i, ((a, _), (b, wide)) in enumerate(combinations(blocks, 2)):
        keys.append(F.shiftleft(F.lit(i).cast("bigint"), 48).bitwiseOR(F.shiftleft(a, wide)).bitwiseOR(b))
    return F.array(*keys)


def links(prints: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """(a, b): pairs of the distinct fingerprints `fp` within radius bits whose components are all components."""
    shards = prints.select("fp", F.explode(shard_keys(F.col("fp"), radius)).alias("shard"))
    sizes = shards.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    large = staged(
        sizes.where(F.col("n") > tree).select("shard", F.ceil(F.col("n") / tree).cast("int").alias("trees")), "shards"
    )
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    visits = F.expr("transform(sequence(0, trees - 1), j -> struct(least(own, j) as i, greatest(own, j) as j))")
    dealt = (
        shards.join(large, "shard", "left").withColumn("trees", F.coalesce("trees", F.lit(1))).withColumn("own", own)
        .withColumn("visit", F.explode(visits))
        .select("shard", "visit.i", "visit.j", (F.col("own") != F.col("visit.i")).alias("guest"), "fp")
        .repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j", "guest", "fp")
    )
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def run(batches):
        group, bk, root = None, BKTree(), {}

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            found: list[tuple[int, int]] = []
            columns = (batch.column(c).to_pylist() for c in ("shard", "i", "j", "guest", "fp"))
            for shard, i, j, guest, fp in zip(*columns, strict=True):
                if (shard, i, j) != group:
                    group, bk, root = (shard, i, j), BKTree(), {}
                root[fp] = fp
                if i == j or guest:
                    for at in bk.within(fp, radius):
                        x, y = top(fp), top(bk.prints[at])
                        if x != y:
                            found.append((fp, bk.prints[at]))
                            root[x] = y
                if not guest:
                    bk.add(fp)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(run, schema)


def near_duplicates(marks: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """(fp, component_id, keeper) of every distinct fingerprint of (fp, doc_id, row): the smallest doc_id and the
    first row, by doc_id and then row, that its component holds."""
    prints = staged(
        marks.groupBy("fp").agg(F.min("doc_id").alias("doc"), F.min(F.struct(
            F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("row")
        )).alias("first")), "fingerprints"
    )
    joined = connected_components(links(prints, radius, tree)).withColumnsRenamed({"node": "fp"})
    rooted = staged(
        prints.join(joined, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted"
    )
    groups = rooted.groupBy("root").agg(F.min("doc").alias("component_id"), F.min("first").alias("first"))
    return rooted.select("fp", "root").join(groups, "root").select(
        "fp", "component_id", F.col("first.row").alias("keeper")
    )


def marked(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, row, fp), written once."""
    columns = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return staged(with_fingerprint(columns, "fp", shingle).select("doc_id", "row", "fp"), "marks")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tree: int = TREE
) -> DataFrame:
    """One row of each component: that of the smallest doc_id, the first of equal ones. All columns are kept."""
    row, fp = free_name(docs, "row_"), free_name(docs, "fp_")
    kept = staged(with_fingerprint(docs.withColumn(row, F.monotonically_increasing_id()), fp, shingle), "with-fp")
    marks = kept.select("doc_id", F.col(row).alias("row"), F.col(fp).alias("fp"))
    keepers = near_duplicates(marks, radius, tree).select(F.col("keeper").alias(row)).distinct()
    return kept.join(keepers, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    marks = marked(read_table(spark, folder, "documents"), SHINGLE)
    groups = near_duplicates(marks)
    return marks.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


QUERIES = {"op4_simhash": op4_simhash}
SQL: dict[str, str] = {}
