"""Token counts as delta-maintained rollups.

A log of changes comes in batches: inserts, deletes and revised counts of documents. Each batch becomes signed
deltas of additive totals by source, language and tokenizer version; the totals are the sum of the deltas of all
committed batches, and never counted anew. A batch is committed once: its deltas are written below its name, and
a batch whose deltas are complete is left as it is when it comes again, so redelivery and retries change nothing.
A batch that was interrupted while written counts nowhere and is written anew. A compacted rollup holds the totals
and the names of the batches in them in one table, so these stay committed.

Changes are (op, doc_id, source, lang, tokenizer, n_tokens, and for revisions old_source, old_lang, old_tokenizer,
old_tokens): insert adds a document, delete takes it away with the counts it had, revise does both at once. A
column `times`, if there is one, says how many documents a row stands for (null: one). Other columns are ignored.
Nulls in source, lang or tokenizer are values of their own; null counts count 0. Several changes of one document
in a batch all count; repeated rows count each. An empty batch is a batch without deltas, a folder that is missing
or has no complete batch a rollup without totals. An unknown op is an error. Texts are counted whole.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from basketry.functions.lineage import fresh_path, staged
from basketry.llm.common import read_table
from basketry.llm.tokens import text_encoder, tokenizer_path

KEYS = ("source", "lang", "tokenizer")
VERSIONS = {"word_bpe_49k": "word_bpe_49k.json", "piece_bpe_32k": "piece_bpe_32k.model"}
DELTAS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, batch string"


@lru_cache(maxsize=4)
def token_counter(file: str) -> Callable[[bytes], int]:
    """Counts the tokens of a text by a public tokenizer: a sentencepiece model or a JSON file."""
    if file.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=file)
        return lambda text: len(model.encode(text.decode()))
    encoder = text_encoder(file)
    width = struct.calcsize(f"<{encoder.letter}")
    return lambda text: len(encoder.ids(text)) // width


def with_token_counts(docs: DataFrame, counts: dict[str, str]) -> DataFrame:
    """The rows of docs with the tokens of their whole text, a column for each tokenizer file; null texts have none."""
    schema = StructType([*docs.schema.fields, *(StructField(name, LongType()) for name in counts)])
    at = docs.columns.index("text")

    def run(batches):
        counters = [token_counter(file) for file in counts.values()]
        for batch in batches:
            texts = [t.as_py() for t in batch.column(at).cast(pa.binary())]
            made = [pa.array([count(t) if t else 0 for t in texts], pa.int64()) for count in counters]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema.fieldNames())

    return docs.mapInArrow(run, schema)


def signed_deltas(changes: DataFrame) -> DataFrame:
    """Sums of what the changes add to and take from the totals, by source, lang and tokenizer."""
    times = F.coalesce(F.col("times"), F.lit(1)) if "times" in changes.columns else F.lit(1)

    def part(sign: int, prefix: str, tokens: str):
        keys = [F.col(prefix + k).cast("string").alias(k) for k in KEYS]
        n = (sign * times).cast("bigint")
        return F.struct(*keys, n.alias("n_docs"), (n * F.coalesce(F.col(tokens), F.lit(0))).cast("bigint").alias("n_tokens"))

    plus, minus, old = part(1, "", "n_tokens"), part(-1, "", "n_tokens"), part(-1, "old_", "old_tokens")
    unknown = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null"))))
    parts = (
        F.when(F.col("op") == "insert", F.array(plus)).when(F.col("op") == "delete", F.array(minus))
        .when(F.col("op") == "revise", F.array(old, plus)).otherwise(unknown)
    )
    signed = changes.select(F.explode(parts).alias("d")).select("d.*")
    return (
        signed.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        .where("n_docs <> 0 or n_tokens <> 0")
    )


class Rollup:
    """Totals kept in a folder all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _place(self, batch_id: str) -> str:
        if not batch_id or not all(c.isalnum() or c in "._-" for c in batch_id):
            raise ValueError("a batch id is made of letters, digits, dots, dashes and underscores")
        return f"{self.path}/batch-{batch_id}"

    def _complete(self, pattern: str) -> list[str]:
        """The folders of batches whose writer has left _SUCCESS, which it does when all of a batch is in place."""
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}/_SUCCESS")
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(place)
        return sorted(x.getPath().getParent().toString() for x in found or ())

    def committed(self, batch_id: str) -> bool:
        if self._complete(self._place(batch_id).rpartition("/")[2]):
            return True
        compacted = self._complete("compacted")
        return bool(compacted) and not (
            self.spark.read.schema(DELTAS).parquet(*compacted).where(F.col("batch") == batch_id).isEmpty()
        )

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch; False if it was committed before, and then nothing changes."""
        if self.committed(batch_id):
            return False
        signed_deltas(changes).write.mode("overwrite").parquet(self._place(batch_id))
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) of the documents that are there."""
        folders = self._complete("batch-*") + self._complete("compacted")
        deltas = (
            self.spark.read.schema(DELTAS).parquet(*folders) if folders else self.spark.createDataFrame([], DELTAS)
        )
        return (
            deltas.where(F.col("batch").isNull())
            .groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("n_docs <> 0 or n_tokens <> 0")
        )

    def compact(self, into: str) -> Rollup:
        """A rollup in another folder with the same totals and the same batches committed, in one table. Its rows
        with a name in `batch` are the batches."""
        other = Rollup(self.spark, into)
        if other._complete("*"):
            raise ValueError(f"{into} holds a rollup")
        names = [place.rpartition("/batch-")[2] for place in self._complete("batch-*")]
        ids = self.spark.createDataFrame([(n,) for n in names], "batch string")
        if compacted := self._complete("compacted"):
            earlier = self.spark.read.schema(DELTAS).parquet(*compacted)
            ids = ids.union(earlier.where(F.col("batch").isNotNull()).select("batch"))
        rows = self.totals().unionByName(ids, allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(f"{other.path}/compacted")
        return other


def document_changes(counted: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A log over documents (source, lang, first, second, copies, extra): all are inserted with their tokens by the
    first tokenizer; then all are revised to the second one; then the extra copies are deleted."""
    old, new = (F.lit(v).alias("tokenizer") for v in VERSIONS)
    none = [F.lit(None).cast("string").alias(f"old_{k}") for k in KEYS] + [F.lit(None).cast("bigint").alias("old_tokens")]

    def changes(op: str, tokenizer, tokens: str, times: str, before: list) -> DataFrame:
        return counted.where(F.col(times) > 0).select(
            F.lit(op).alias("op"), "source", "lang", tokenizer, F.col(tokens).alias("n_tokens"), *before,
            F.col(times).alias("times"),
        )

    was = [F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), old.alias("old_tokenizer"),
           F.col("first").alias("old_tokens")]
    return (
        changes("insert", old, "first", "copies", none), changes("revise", new, "second", "copies", was),
        changes("delete", new, "second", "extra", none),
    )


def copies_by_source(counted: DataFrame) -> DataFrame:
    """(source, lang, first, second, copies, extra) of rows (doc_id, digest, source, lang, first, second): the rows of
    a digest in each source and language, and how many of them are not the digest's first by doc_id.

    Rows of a digest are counted before they meet, so the copies of one text are a row per source and language.
    """
    groups = counted.groupBy("digest", "source", "lang").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id"),
        F.any_value("first").alias("first"), F.any_value("second").alias("second"),
    )
    order = Window.partitionBy("digest").orderBy(F.col("doc_id").asc_nulls_last(), "source", "lang")
    leads = (F.row_number().over(order) == 1).cast("bigint")
    return groups.select("source", "lang", "first", "second", "copies", (F.col("copies") - leads).alias("extra"))


def op7_rollups(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after all documents were inserted with the tokens of one tokenizer, revised to those of another, and
    copies of a text with a smaller doc_id deleted. Every batch is delivered twice, the last time after compaction."""
    docs = read_table(spark, folder, "documents").select(
        "doc_id", "source", "lang", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
    )
    files = dict(zip(("first", "second"), map(tokenizer_path, VERSIONS.values()), strict=True))
    counted = staged(with_token_counts(docs, files).drop("text"), "token-counts")
    grouped = staged(copies_by_source(counted), "token-changes")
    rollup = Rollup(spark, fresh_path(spark, "rollup"))
    log = list(zip(("load", "revise", "dedupe"), document_changes(grouped), strict=True))
    for batch_id, changes in log:
        rollup.commit(batch_id, changes)
    rollup = rollup.compact(fresh_path(spark, "rollup"))
    for batch_id, changes in log:
        rollup.commit(batch_id, changes)
    return rollup.totals()


QUERIES = {"op7_rollups": op7_rollups}
SQL: dict[str, str] = {}
