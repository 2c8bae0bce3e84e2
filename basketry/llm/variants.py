"""Spelling variants: words one edit apart, found through their permuterm rotations.

A word w = a x b, ended by a terminator, has one rotation for each place; the rotation that starts right after x
reads `b$a x`. Its prefix `b$a`, which skips the edited character x, is shared by all words that replace x and is
itself a whole rotation of the word `ab` that lacks x. So all words one replacement or indel apart meet in prefix
ranges of the sorted rotations. A range has one member per character of the alphabet at most, plus the word
without it, whatever the number of words; ranges are scanned and hand each member its near words' number and the
best of them, never a list of pairs.

Rotations carry a word's count and its number in code-point order instead of its text. For words longer than
LONG the prefix stands as digests of a and b, built up along the word, so a run of a million letters costs a
million short rows and not their square.

Null and blank texts have no words, repeated rows count again, ties go to the smallest word in code-point order,
tables without rows give none, and other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType
from zlib import crc32

from basketry.functions.lineage import staged
from basketry.functions.numbering import consecutive
from basketry.llm.common import read_table, text_bytes

LEAST_LENGTH, LEAST_COUNT, STRONGER = 5, 3, 2
LONG = 64  # code points of a word whose rotations are still written out
HELD_WORDS, ROWS_AT_ONCE = 200_000, 100_000
END = "$"
WHOLE, SKIP, SKIP_AGAIN = 0, 1, 2  # a rotation; one without a character; the same, the character before being equal


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, change: Callable[[bytes, str], str] | None = None,
) -> DataFrame:
    """(word, n) of all runs of Latin letters, A-Z in lower case. change(key, word), if given, rewrites a run first.

    Counts leave a task once per HELD_WORDS words, so a frequent word is a few rows to the shuffle.
    """
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")
    schema = StructType([StructField("word", StringType()), StructField("n", LongType())])

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema.fieldNames()
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at, found in enumerate(text_bytes(batch, batch.schema.names[1])):
                if not found:
                    continue
                words = runs.findall(found.lower().decode())
                if change is None:
                    held.update(words)
                else:
                    own = b"" if keys[at] is None else str(keys[at]).encode()
                    for word, n in Counter(words).items():
                        word = change(own, word)
                        if len(word) >= least_length:
                            held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out(held)
                    held.clear()
        if held:
            yield out(held)

    counted = docs.select(key, text).mapInArrow(run, schema)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(word: str) -> Iterator[tuple[bytes, int]]:
    """(key, kind) of a word's rotations, whole and without their last character."""
    length = len(word)
    if length <= LONG:
        for i in range(length + 1):
            yield (word[i:] + END + word[:i]).encode(), WHOLE
            if i < length:
                kind = SKIP_AGAIN if i and word[i] == word[i - 1] else SKIP
                yield (word[i + 1 :] + END + word[:i]).encode(), kind
        return
    # Digests of word[i:] for every i, then of word[:i] on the way.
    state, tails = hashlib.blake2b(digest_size=16), [b""] * (length + 1)
    for i in range(length, -1, -1):
        if i < length:
            state.update(word[i].encode("utf-32-le"))
        tails[i] = state.copy().digest()
    state = hashlib.blake2b(digest_size=16)
    for i in range(length + 1):
        head = b"\xff" + state.copy().digest()  # \xff: no UTF-8 text starts so
        # The length of the joined word keeps keys of different lengths apart.
        yield head + tails[i], WHOLE
        if i < length:
            yield head + tails[i + 1], SKIP_AGAIN if i and word[i] == word[i - 1] else SKIP
            state.update(word[i].encode("utf-32-le"))


def rotation_rows(words: DataFrame) -> DataFrame:
    """(key, kind, n, number) of all rotations of words (word, n, number)."""
    schema = StructType([
        StructField("key", BinaryType()), StructField("kind", IntegerType()), StructField("n", LongType()),
        StructField("number", LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, kinds, counts, numbers = [], [], [], []

        def out():
            return pa.RecordBatch.from_arrays([
                pa.array(keys, pa.binary()), pa.array(kinds, pa.int32()), pa.array(counts, pa.int64()),
                pa.array(numbers, pa.int64()),
            ], schema.fieldNames())

        for batch in batches:
            for word, n, number in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                for key, kind in rotations(word):
                    keys.append(key)
                    kinds.append(kind)
                    counts.append(n)
                    numbers.append(number)
                    if len(keys) >= ROWS_AT_ONCE:
                        yield out()
                        for held in (keys, kinds, counts, numbers):
                            held.clear()
        if keys:
            yield out()

    # A word becomes many rows, so words are dealt out over all tasks of a shuffle first.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return words.select("word", "n", "number").repartition(tasks, "number").mapInArrow(run, schema)


def near_words(words: DataFrame) -> DataFrame:
    """(number, n_near, best_n, best) of words (word, n, number) that have a near word.

    best is the number of the near word of largest n, of these the smallest. A pair meets in one range only:
    for a replacement that of its place, for an indel that of the first place of a run of equal characters.
    """
    def near(m: Column, members: Column) -> Column:
        other = F.filter(members, lambda x: (x["number"] != m["number"]) & (
            ((x["kind"] > WHOLE) & (m["kind"] > WHOLE)) | (x["kind"] + m["kind"] == SKIP)
        ))
        return F.struct(
            m["number"].alias("number"), F.size(other).alias("near"),
            F.array_max(F.transform(other, lambda x: F.struct(x["n"], -x["number"]))).alias("best"),
        )

    ranges = rotation_rows(words).groupBy("key").agg(F.collect_list(F.struct("kind", "n", "number")).alias("members"))
    scanned = (
        ranges.where(F.size("members") > 1)
        .select(F.explode(F.transform("members", lambda m: near(m, F.col("members")))).alias("m"))
        .select("m.*")
        .where(F.col("near") > 0)
    )
    found = scanned.groupBy("number").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    return found.select("number", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.col2")).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(number, root): where the links (number, form) lead to. Counts at least double along a link, so paths
    are short and jumping over the path already known ends after a few rounds, each written once."""
    at = staged(links.select("number", F.col("form").alias("root")), "spelling-roots")
    while True:
        known = at.select(F.col("number").alias("root"), F.col("root").alias("_next"))
        moved = at.join(known, "root", "left").select(
            "number", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")
        )
        moved = staged(moved, "spelling-roots")
        at = moved.select("number", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_variants(words: DataFrame, stronger: int = STRONGER) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (word, n).

    A word's form is its near word of largest n, if that is at least `stronger` times its own; its root is where
    forms lead to.
    """
    numbered = staged(consecutive(words.select("word", "n"), [F.col("word")], "number"), "spelling-words")
    near = staged(
        near_words(numbered).join(numbered.select("number", "n"), "number")
        .select("number", "n_near", "best_n", F.when(F.col("best_n") >= stronger * F.col("n"), F.col("best")).alias("form")),
        "spelling-near",
    )
    links = near.where(F.col("form").isNotNull()).select("number", "form", F.col("best_n").alias("form_n"))
    led = links.join(roots(links), "number")
    texts = numbered.select("number", "word")
    named = (
        led.join(texts.select(F.col("number").alias("form"), F.col("word").alias("form_word")), "form")
        .join(texts.select(F.col("number").alias("root"), F.col("word").alias("root_word")), "root")
        .select("number", "form_word", "root_word", "form_n")
    )
    return (
        numbered.join(near.select("number", "n_near"), "number", "left").join(named, "number", "left")
        .select(
            "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n",
        )
    )


def misspelt(key: bytes, word: str) -> str:
    """The run without one code point in one of 97 (document, run) pairs, by the CRC-32 of both."""
    h = crc32(word.encode(), crc32(key + b":"))
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return spelling_variants(word_counts(docs, change=misspelt))


QUERIES = {"op12_variants": op12_variants}
SQL: dict[str, str] = {}
