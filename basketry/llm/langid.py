"""Language identification by segmentation-marginalised unigrams.

A fixed public vocabulary gives the pieces, all that are letters only, of any length; each language has a
probability for every piece. The probability of a word is the sum over all its segmentations into pieces, by a
forward pass over the pieces' trie that is kept in a double's range however long the word is; that of a text is
the product over its letter runs, as no piece crosses one. The piece probabilities are fitted by expectation-maximisation over
word counts of a sample of labelled texts, about TRAIN_DOCS of each language, chosen by a hash of the row's id.

Letters that no piece holds cost the same in every language. A text that is null or has no letter is `und` with
score 0. The score is the posterior probability of the predicted language under equal priors; ties go to the
first language in order. Languages without any learned word, and an empty table, give `und` for every text.
Repeated rows are judged alike; every row is judged, by its whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from basketry.functions.lineage import staged
from basketry.llm.common import free_name, read_table
from basketry.llm.tokens import Recent, tokenizer_path

VOCABULARY = "piece_bpe_32k.model"
TRAIN_DOCS, ROUNDS, UNKNOWN = 400, 3, "und"
_WORD = re.compile(r"[^\W\d_]+")
_FLOOR, _SMOOTH, _TINY = 1e-9, 0.05, 1e-100


def letter_pieces(model_file: str) -> list[str]:
    """Lower-case pieces of the vocabulary that are letters only, in order."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    bare = {model.id_to_piece(i).lstrip("▁").lower() for i in range(model.get_piece_size())}
    return sorted(p for p in bare if p.isalpha())


def words_of(text: str | None) -> list[str]:
    """Lower-case letter runs; none if the text has no letter."""
    found = _WORD.findall(text.lower()) if text else []
    return found if any(c.isalpha() for w in found for c in w) else []


class PieceModel:
    """Probabilities of pieces by language, and what they give words."""

    def __init__(self, languages: list[str], table: dict[str, tuple[float, ...]]):
        self.languages, self.table = languages, table
        self.floor = (_FLOOR,) * len(languages)
        self._plant()

    def _plant(self) -> None:
        # A node of the trie: the nodes behind each letter, and the probabilities of the piece that ends here or None.
        self.trie: list = [{}, None]
        for piece, p in self.table.items():
            node = self.trie
            for letter in piece:
                node = node[0].setdefault(letter, [{}, None])
            node[1] = p

    def __getstate__(self):
        return self.languages, self.table

    def __setstate__(self, state):
        self.__init__(*state)

    def edges(self, word: str, start: int) -> list[tuple[int, tuple[float, ...]]]:
        """(end, probabilities) of the pieces that begin at a place of the word. A letter that is no piece of its
        own is one, at the same small probability in every language."""
        found, node = [], self.trie
        for end in range(start + 1, len(word) + 1):
            node = node[0].get(word[end - 1])
            if node is None:
                break
            if node[1] is not None:
                found.append((end, node[1]))
        if not found or found[0][0] != start + 1:
            found.insert(0, (start + 1, self.floor))
        return found

    def forward(self, word: str) -> tuple[float, ...]:
        """Log-probability of the word in each language, over all segmentations.

        Only the sums of places ahead are held; they are scaled up before the next one leaves a double's range.
        """
        trie, floor, length = self.trie, self.floor, len(word)
        logs = [0.0] * len(floor)
        ahead = {0: [1.0] * len(floor)}
        for start in range(length):
            here = ahead.pop(start)
            if min(here) < _TINY:
                logs = [x + math.log(y) for x, y in zip(logs, here, strict=True)]
                for end, waiting in ahead.items():
                    ahead[end] = [x / y for x, y in zip(waiting, here, strict=True)]
                here = [1.0] * len(floor)
            node, end, alone = trie, start, floor
            while end < length:
                node = node[0].get(word[end])
                if node is None:
                    break
                end += 1
                p = node[1]
                if p is not None:
                    if end == start + 1:
                        alone = p
                    elif end in ahead:
                        ahead[end] = [x + y * q for x, y, q in zip(ahead[end], here, p)]
                    else:
                        ahead[end] = [y * q for y, q in zip(here, p)]
            # One letter: a piece, or a sign without one.
            if start + 1 in ahead:
                ahead[start + 1] = [x + y * q for x, y, q in zip(ahead[start + 1], here, alone)]
            else:
                ahead[start + 1] = [y * q for y, q in zip(here, alone)]
        return tuple(x + math.log(y) for x, y in zip(logs, ahead[length], strict=True))

    def expected(self, word: str, language: int, times: float, into: Counter) -> None:
        """Add the expected uses of pieces in the word, by forward and backward sums of logarithms."""
        n = len(word)
        edges = [[(end, p[language]) for end, p in self.edges(word, start)] for start in range(n)]
        back = [0.0] * (n + 1)
        for start in range(n - 1, -1, -1):
            most = max(back[end] for end, _ in edges[start])
            back[start] = most + math.log(sum(math.exp(back[end] - most) * p for end, p in edges[start]))
        # ahead[i]: the share of the segmentations' probability that has a border at place i.
        ahead = [1.0] + [0.0] * n
        for start in range(n):
            if not ahead[start]:
                continue
            for end, p in edges[start]:
                share = ahead[start] * p * math.exp(back[end] - back[start])
                ahead[end] += share
                piece = word[start:end]
                if piece in self.table:
                    into[piece] += times * share


def word_counts(samples: DataFrame, languages: list[str]) -> DataFrame:
    """(language, word, n) of the sampled texts, written once."""
    number = {name: i for i, name in enumerate(languages)}
    schema = StructType([
        StructField("language", LongType()), StructField("word", StringType()), StructField("n", LongType())
    ])

    def run(batches):
        for batch in batches:
            counts: Counter = Counter()
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                k = number[lang]
                counts.update((k, w) for w in words_of(text))
            if counts:
                keys, n = zip(*counts.items(), strict=True)
                language, word = zip(*keys, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(language, pa.int64()), pa.array(word), pa.array(n, pa.int64())], schema.fieldNames()
                )

    counted = samples.select("text", "lang").mapInArrow(run, schema)
    return staged(counted.groupBy("language", "word").agg(F.sum("n").alias("n")).repartition(16), "word-counts")


def piece_sums(counts: DataFrame, model: PieceModel) -> dict[tuple[int, str], float]:
    """Expected uses of each piece by language. At most pieces x languages numbers leave the executors."""
    schema = StructType([
        StructField("language", LongType()), StructField("piece", StringType()), StructField("uses", DoubleType())
    ])

    def run(batches):
        into = [Counter() for _ in model.languages]
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("language", "word", "n"))
            for language, word, n in zip(*columns, strict=True):
                model.expected(word, language, n, into[language])
        rows = [(k, piece, uses) for k, c in enumerate(into) for piece, uses in c.items()]
        if rows:
            language, piece, uses = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(language, pa.int64()), pa.array(piece), pa.array(uses, pa.float64())], schema.fieldNames()
            )

    # Sums of doubles depend on their order, so they are rounded before they are added.
    uses = F.sum(F.round(F.col("uses") * 1e4).cast("bigint"))
    sums = counts.mapInArrow(run, schema).groupBy("language", "piece").agg(uses.alias("uses"))
    return {(r["language"], r["piece"]): r["uses"] / 1e4 for r in sums.collect()}


def sampled(docs: DataFrame, per_language: int, key: Column) -> tuple[DataFrame, list[str]]:
    """About per_language labelled rows of each language, chosen by a hash of key, and the languages in order."""
    labelled = docs.where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return labelled, []
    share = F.lit(0.0)
    for lang, n in sorted(sizes.items()):
        share = F.when(F.col("lang") == lang, min(1.0, per_language / n)).otherwise(share)
    chosen = F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(1_000_000)) < share * 1_000_000
    return labelled.where(chosen), sorted(sizes)


def fit(
    docs: DataFrame, vocabulary: str, per_language: int = TRAIN_DOCS, rounds: int = ROUNDS, key: str = "doc_id"
) -> PieceModel:
    """Piece probabilities from labelled rows (text, lang) of docs. Rows with a null lang teach nothing."""
    pieces = letter_pieces(vocabulary)
    samples, languages = sampled(docs, per_language, F.col(key))
    flat = (1.0 / max(1, len(pieces)),) * len(languages)
    model = PieceModel(languages, dict.fromkeys(pieces, flat))
    if not languages:
        return model
    counts = word_counts(samples, languages)
    for _ in range(rounds):
        sums = piece_sums(counts, model)
        totals = [_SMOOTH * len(pieces)] * len(languages)
        for (k, _), uses in sums.items():
            totals[k] += uses
        model = PieceModel(languages, {
            piece: tuple((sums.get((k, piece), 0.0) + _SMOOTH) / totals[k] for k in range(len(languages)))
            for piece in pieces
        })
    return model


class TextScorer:
    """Predictions for texts; scores of recent words are kept."""

    def __init__(self, model: PieceModel, kept: int = 200_000):
        self.model, self.rows = model, Recent(self._row, kept)

    def _row(self, word: str) -> bytes:
        return np.array(self.model.forward(word)).tobytes()

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        many = len(self.model.languages)
        if not words or not many:
            return UNKNOWN, 0.0
        logs = np.frombuffer(b"".join(map(self.rows.__getitem__, words))).reshape(-1, many).sum(0)
        best = int(logs.argmax())
        return self.model.languages[best], float(1 / np.exp(logs - logs[best]).sum())


def predict(docs: DataFrame, model: PieceModel, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows of docs with the predicted language and its score."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # pieces x languages: bounded by the vocabulary
    schema = StructType([*docs.schema.fields, StructField(lang, StringType()), StructField(score, DoubleType())])

    def run(batches):
        scorer = TextScorer(shared.value)
        for batch in batches:
            found = [scorer.predict(t.as_py()) for t in batch.column("text")]
            langs, scores = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], schema.fieldNames()
            )

    return docs.mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """Rows that no model learns from: the remainder of crc32(id as text) by 3 is 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def keep_identified(docs: DataFrame, least: float = 0.5, vocabulary: str | None = None) -> DataFrame:
    """Rows of docs whose language is identified: a text with letters, one language likelier than all others
    together. The columns stay as they are."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), vocabulary or tokenizer_path(VOCABULARY))
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score_")
    judged = predict(docs, model, lang, score)
    kept = judged.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))), tokenizer_path(VOCABULARY))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


QUERIES = {"op6_langid": op6_langid}
SQL: dict[str, str] = {}
