"""Mixture-controlled packing of documents into fixed windows of tokens.

Every source is a queue of tokens: its documents one after another. A deficit round-robin visits the queues:
in each round a queue is owed its target share of a window and serves whole tokens; the fraction it is still
owed is carried into the next round, whatever window or partition that round falls in. A queue that runs dry
drops out and the later rounds are shorter, so windows then hold the rest in their own proportions. What the
first k queues have served after r rounds is floor(r * their quotas), so while all queues last a round fills a
window exactly, and the place of every token follows from its place in its queue and the table of queues alone:
nothing is served one after another on one machine, and each document cuts itself. Only the last window may
hold fewer tokens than the others.

Target shares are those given, or else the corpus's own. A source that would get fewer than `least` tokens of
a window joins the others of its kind in one queue; so there are at most window / least + 1 queues and pieces
do not become crumbs. No document is dropped.

Null and empty texts are documents of the end token alone. A null source is a source. Repeated rows are
packed each. An empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from basketry.functions.lineage import staged
from basketry.llm.common import read_table
from basketry.llm.tokens import joined, text_encoder, tokenizer_path

WINDOW = 4096
LEAST = 32
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
# A queue's quota of a round is counted in parts of a token.
_PARTS = 16
_NULL_SOURCE, _SOURCE = "-", "="
# Bytes of texts or ids that a task works on at once, and parts of words whose ids a worker keeps: larger ones
# save encoding, but tasks of other stages find less memory left in the workers they share.
SLICE_BYTES = 16 << 20
KEPT_PARTS = 200_000


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices with less than so many bytes of a binary column behind their first row.

    What Arrow took for a slice goes back to the system before the next one.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if high > low:
            yield batch.slice(low, high - low)
            pa.default_memory_pool().release_unused()


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, queue, part, local, n, ids: the token ids of every row, and where it stands in its part's queue.

    `part` is the task that read the row; written once, it is a fixed name for a bounded set of rows.
    """
    key = F.when(F.col("source").isNull(), _NULL_SOURCE).otherwise(F.concat(F.lit(_SOURCE), "source"))
    schema = StructType([
        StructField("doc_id", LongType()), StructField("queue", StringType()), StructField("part", IntegerType()),
        StructField("local", LongType()), StructField("n", IntegerType()), StructField("ids", BinaryType()),
    ])

    def run(batches):
        encoder = text_encoder(tokenizer, KEPT_PARTS)
        part, served = TaskContext.get().partitionId(), {}
        for batch in (x for whole in batches for x in slices(whole, "text")):
            ids, ends = encoder.column(batch.column("text"))
            sizes = np.diff(ends, prepend=0) + 1
            local = []
            for queue, size in zip(batch.column("queue").to_pylist(), sizes.tolist(), strict=True):
                before = served.get(queue, 0)
                local.append(before)
                served[queue] = before + size
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("queue"), pa.array([part] * len(sizes), pa.int32()),
                pa.array(local, pa.int64()), pa.array(sizes, pa.int32()), joined(np.insert(ids, ends, end_id), sizes),
            ], schema.fieldNames())

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("queue"), F.col("text").cast("binary").alias("text")
    )
    return staged(rows.mapInArrow(run, schema), "token-ids")


def queue_table(
    totals: DataFrame, targets: Mapping[str | None, float] | None, window: int, least: int
) -> list[tuple[str | None, int, int]]:
    """(queue, tokens, share of a window) of the queues, the joint queue (None) first.

    totals has a row per source and part. At most window / least sources reach the least share.
    """
    by_source = totals.groupBy("queue").agg(F.sum("tokens").alias("tokens"))
    if targets is None:
        everything = by_source.agg(F.sum("tokens")).first()[0] or 0
        own = by_source.where(F.col("tokens") * window >= F.lit(least * everything))
        shares = {r["queue"]: (r["tokens"], r["tokens"] / everything) for r in own.collect()}
    else:
        named = {_NULL_SOURCE if k is None else _SOURCE + k: float(w) for k, w in targets.items()}
        whole = sum(w for w in named.values() if w > 0) or 1.0
        wanted = {k: w / whole for k, w in named.items() if w / whole * window >= least}
        found = by_source.where(F.col("queue").isin(list(wanted))).collect() if wanted else []
        shares = {r["queue"]: (r["tokens"], wanted[r["queue"]]) for r in found}
    rest = by_source.where(~F.col("queue").isin(list(shares))) if shares else by_source
    remaining = rest.agg(F.sum("tokens")).first()[0] or 0
    rows = [(k, n, share) for k, (n, share) in sorted(shares.items())]
    if remaining:
        # Sources without a target of their own get what the targets leave, or the least share.
        rows.insert(0, (None, remaining, max(1 - sum(x[2] for x in rows), least / window)))
    return rows


class Rounds:
    """Where the tokens of a queue go, by arithmetic on the table of queues."""

    def __init__(self, sizes: list[int], shares: list[float], window: int):
        self.sizes, self.window = np.array(sizes, np.int64), window
        sums = np.cumsum(shares) / (sum(shares) or 1)
        self.sums = np.concatenate([[0], np.rint(sums * (window << _PARTS))]).astype(np.int64)

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens each queue has served after so many rounds, one row per entry of rounds."""
        return np.minimum(self.sizes, np.diff((rounds[:, None] * self.sums) >> _PARTS, axis=1))

    def pieces(self, queue: int, start: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first token, length, place in the stream of all tokens) of the pieces of a document that begins
        at `start` of its queue."""
        quota, end = int(self.sums[queue + 1] - self.sums[queue]), start + size
        rounds = np.arange(max(0, ((start - 1) << _PARTS) // quota), ((end + 1) << _PARTS) // quota + 2)
        served = self.served(rounds)
        before, after = served[:-1], served[1:]
        places = before.sum(1) + (after - before)[:, :queue].sum(1) - before[:, queue]
        low = np.maximum(before[:, queue], start)
        high = np.minimum(after[:, queue], end)
        some = high > low
        low, high, places = low[some], high[some], places[some] + low[some]
        # At most one window edge lies inside what one round serves, as a round is no longer than a window.
        edge = (places // self.window + 1) * self.window
        cut = low + np.minimum(edge - places, high - low)
        lows = np.stack([low, cut], 1).ravel()
        highs = np.stack([cut, high], 1).ravel()
        places = np.stack([places, edge], 1).ravel()
        some = highs > lows
        lows, highs, places = lows[some], highs[some], places[some]
        # Neighbours in the document that are neighbours in a window are one piece.
        fresh = np.ones(len(lows), bool)
        fresh[1:] = (lows[1:] - places[1:] != lows[:-1] - places[:-1]) | (
            places[1:] // self.window != places[:-1] // self.window
        )
        at = np.flatnonzero(fresh)
        ends = highs[np.append(at[1:] - 1, len(lows) - 1)]
        return lows[at] - start, ends - lows[at], places[at]


def pack_documents(
    docs: DataFrame, tokenizer: str, targets: Mapping[str | None, float] | None = None, window: int = WINDOW,
    end_id: int = END_ID, least: int = LEAST,
) -> DataFrame:
    """Pieces of documents (doc_id, text, source) in windows: doc_id, source, start, length, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset. targets: wanted share by source; None: the corpus's own."""
    encoded = encode_documents(docs, tokenizer, end_id)
    totals = staged(encoded.groupBy("queue", "part").agg(F.sum("n").alias("tokens")), "queue-totals")
    table = queue_table(totals, targets, window, least)
    names = [k for k, _, _ in table]
    rounds = Rounds([n for _, n, _ in table], [share for _, _, share in table], window)
    number = F.lit(0)
    for i, name in enumerate(names):
        number = F.when(F.col("queue") == name, i).otherwise(number) if name is not None else number
    # Queue order: source, then the part that read the rows, then the row in the part.
    in_source = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    in_queue = Window.partitionBy("number").orderBy("queue").rowsBetween(Window.unboundedPreceding, -1)
    sources = (
        totals.groupBy("queue").agg(F.sum("tokens").alias("all")).withColumn("number", number)
        .withColumn("earlier", F.coalesce(F.sum("all").over(in_queue), F.lit(0)))
    )
    bases = staged(
        totals.withColumn("before", F.coalesce(F.sum("tokens").over(in_source), F.lit(0))).join(sources, "queue")
        .select("queue", "part", "number", (F.col("before") + F.col("earlier")).alias("base")), "queue-bases"
    )
    placed = encoded.join(bases, ["queue", "part"]).select(
        "doc_id", F.expr(f"if(queue = '{_NULL_SOURCE}', null, substring(queue, 2))").alias("source"), "number",
        (F.col("base") + F.col("local")).alias("place"), "n", "ids",
    )
    schema = StructType([
        StructField("doc_id", LongType()), StructField("source", StringType()), StructField("start", LongType()),
        StructField("length", LongType()), StructField("ids", BinaryType()), StructField("doc_tokens", LongType()),
        StructField("sequence_id", LongType()), StructField("offset", LongType()),
    ])

    def run(batches):
        kind = text_encoder(tokenizer, KEPT_PARTS).dtype
        for batch in (x for whole in batches for x in slices(whole, "ids")):
            columns = (batch.column(c).to_pylist() for c in ("number", "place", "n"))
            found = [rounds.pieces(*row) for row in zip(*columns, strict=True)]
            starts, lengths, spots = (np.concatenate(x) for x in zip(*found, strict=True))
            at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x, _, _ in found]))
            # The pieces of a document follow one another and leave nothing out.
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(at), batch.column("source").take(at), pa.array(starts),
                pa.array(lengths), joined(ids, lengths), batch.column("n").cast(pa.int64()).take(at),
                pa.array(spots // window), pa.array(spots % window),
            ], schema.fieldNames())

    return placed.mapInArrow(run, schema)


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack_documents(read_table(spark, folder, "documents"), tokenizer_path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )


QUERIES = {"op2_packing": op2_packing}
SQL: dict[str, str] = {}
