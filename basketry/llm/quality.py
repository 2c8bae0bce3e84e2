"""Quality rules: base counts of a text, then a hashed n-gram log-likelihood ratio.

Single words and pairs of neighbouring words are hashed into BUCKETS buckets. Two multinomials over the buckets
are compared: the raw corpus, counted over every document, and the trusted target, documents labelled good and
not toxic. A text's score is the sum of log(target / raw) over its n-grams, divided by their number; it is kept
if the score is at least the threshold. Log-ratios are whole millionths, so sums and verdicts are the same in
every order of the rows.

The target is fitted on a sample of at most TARGET_DOCS labelled documents, the smallest hashes of doc_id; the
corpus counts have no bound. The target is smoothed towards the raw corpus. Without labels the two are equal and
only the base rules decide.

Null, empty and blank texts have no words: all counts are 0, they fail the base rules and are not kept. Repeated
rows are judged alike; repeated or null labels of a document count once or not at all. An empty table gives no
rows. Everything runs as SQL expressions, row by row, whatever the length of the text.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import beside, bound, read_table, spaced

# The threshold is -0.1 nats an n-gram: text is dropped if the raw corpus explains it clearly better.
BUCKETS, TARGET_DOCS, THRESHOLD = 1 << 14, 20_000, -100_000
LEAST_WORDS, MOST_REPEATED = 50, 50
UNIT = 1_000_000


def hashed_words(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def buckets(hashes: Column, n: int) -> Column:
    """Buckets of the words, then of the pairs of neighbours."""
    pairs = F.zip_with(hashes, F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(1))), lambda a, b: F.struct(a, b))
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(n)).cast("int"))
    double = F.transform(
        F.slice(pairs, 1, F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda p: F.pmod(F.xxhash64(p), F.lit(n)).cast("int"),
    )
    return F.concat(single, double)


def repeated_words(hashes: Column) -> Column:
    """Words inside three-word windows that the text has twice or more.

    Windows are sorted by hash, with their positions; the positions of those equal to a neighbour are sorted
    again, and each covers three words, less where the next one begins earlier.
    """
    def windows(h: Column) -> Column:
        keyed = F.transform(
            F.sequence(F.lit(1), F.size(h) - 2),
            lambda i: F.struct(F.xxhash64(F.get(h, i - 1), F.get(h, i), F.get(h, i + 1)).alias("k"), i.alias("i")),
        )
        return bound(F.sort_array(keyed), positions)

    def positions(sorted_: Column) -> Column:
        def again(x: Column, at: Column) -> Column:
            same = lambda y: F.coalesce(y["k"] == x["k"], F.lit(False))
            return same(F.get(sorted_, at - 1)) | same(F.get(sorted_, at + 1))

        return bound(F.sort_array(F.transform(F.filter(sorted_, again), lambda x: x["i"])), covered)

    def covered(at: Column) -> Column:
        gaps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.least(
            F.coalesce(b - a, F.lit(3)), F.lit(3)
        ))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)

    distinct = bound(
        F.transform(F.sequence(F.lit(1), F.size(hashes) - 2), lambda i: F.xxhash64(
            F.get(hashes, i - 1), F.get(hashes, i), F.get(hashes, i + 1)
        )),
        lambda k: F.size(F.array_distinct(k)) < F.size(k),
    )
    zero = F.lit(0).cast("bigint")
    return F.when(F.size(hashes) < 4, zero).when(~distinct, zero).otherwise(windows(hashes))


COUNTS = ("n_words", "word_chars", "hashes", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_counts(docs: DataFrame) -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and `hashes` of their words. Of
    columns of docs with these names, the counts get underscores."""
    return beside(docs, COUNTS, _base_counts, inner=("_w",))


def _base_counts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    zero = F.lit(0).cast("bigint")
    counted = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        bound(spaced(F.col("text")), lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            hashed_words(w).alias("hashes"),
        )).alias("_w"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
    )
    return counted.select(
        "*", F.col("_w.n_words").alias("n_words"), F.coalesce("_w.word_chars", zero).alias("word_chars"),
        F.col("_w.hashes").alias("hashes"),
    ).withColumn("n_repeat_words", repeated_words(F.col("hashes"))).drop("_w")


def trusted_ids(labels: DataFrame, most: int) -> DataFrame:
    """At most `most` ids of documents labelled good and not toxic, the smallest hashes first."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def bucket_counts(docs: DataFrame, n: int) -> dict[int, int]:
    """n-grams by bucket, over all the rows; at most n numbers leave the executors."""
    grams = docs.select(F.explode(bound(hashed_words(spaced(F.col("text"))), lambda h: buckets(h, n))).alias("b"))
    return {r["b"]: r["n"] for r in grams.groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()}


def log_ratios(docs: DataFrame, labels: DataFrame, n: int = BUCKETS, target_docs: int = TARGET_DOCS) -> list[int]:
    """log(target / raw) of every bucket in millionths."""
    raw = bucket_counts(docs, n)
    every = sum(raw.values())
    trusted = docs.select("doc_id", "text").join(F.broadcast(trusted_ids(labels, target_docs)), "doc_id", "left_semi")
    target = bucket_counts(trusted, n)
    if not target:
        return [0] * n
    # The target is smoothed with n counts spread like the raw corpus, so little evidence pulls a ratio to 1.
    all_target = sum(target.values())
    return [
        round(UNIT * math.log((target.get(b, 0) / raw[b] * every + n) / (all_target + n))) if b in raw else 0
        for b in range(n)
    ]


def judge(
    docs: DataFrame, ratios: list[int], threshold: int = THRESHOLD, least_words: int = LEAST_WORDS,
    most_repeated: int = MOST_REPEATED,
) -> DataFrame:
    """The rows with their base counts, base_failed, llr (millionths an n-gram, null without n-grams) and kept. Of
    columns of docs with these names, ours get underscores."""
    ours = (*(c for c in COUNTS if c != "hashes"), "base_failed", "llr", "kept")
    compute = partial(_judge, ratios=ratios, threshold=threshold, least_words=least_words, most_repeated=most_repeated)
    return beside(docs, ours, compute, inner=("hashes", "_w", "_g"))


def _judge(docs: DataFrame, ratios: list[int], threshold: int, least_words: int, most_repeated: int) -> DataFrame:
    table = F.from_json(F.lit(str(ratios)), "array<int>")  # folded into one constant
    grams = bound(buckets(F.col("hashes"), len(ratios)), lambda b: F.struct(
        F.aggregate(b, F.lit(0).cast("bigint"), lambda total, x: total + F.get(table, x)).alias("total"),
        F.size(b).cast("bigint").alias("n"),
    ))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    scored = _base_counts(docs).withColumn("_g", grams).drop("hashes")
    return (
        scored.withColumn("base_failed", failed)
        .withColumn("llr", F.when(F.col("_g.n") > 0, F.col("_g.total") / F.col("_g.n")))
        # Compared as whole numbers: total >= threshold * n.
        .withColumn("kept", ~F.col("base_failed") & (F.col("_g.total") >= threshold * F.col("_g.n")))
        .drop("_g")
    )


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    ratios = log_ratios(docs, read_table(spark, folder, "labels"))
    return judge(docs, ratios).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"
    )


QUERIES = {"op5_quality": op5_quality}
SQL: dict[str, str] = {}
