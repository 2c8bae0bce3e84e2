"""Toxicity: misspelled lexicon terms by Levenshtein automata, scored in their context window.

The lexicon is learned from labelled texts: whole words and word stems that mark toxic ones. It is held as a trie.
The Levenshtein automaton and the trie run as one automaton over a word's letters, whose states are the trie nodes
that at most so many edits lead to. A term of LETTERS_FOR_EDIT letters may have one edit, of twice as many minus
one two; a stem needs more and leaves the rest of the word open. Words that the labelled clean texts use and that
only look like a term are known as its innocent neighbours.

A hit is then judged in its window of WINDOW words on each side. Between quotation marks, or beside a cue of
reported speech, it counts as quoted, unless the window speaks to somebody; other hits count as abuse. Sums of the
hits' weights (exact, misspelt, quoted; in all, by length, in the densest window) enter a logistic regression.
Its coefficients are fitted on labelled texts that the lexicon has not seen, towards stated prior values, which
stand where the labelled texts have no example.

The fit takes at most FIT_TOXIC and FIT_CLEAN labelled texts, by a hash of their key; exact copies count once.
Null and empty texts have no hit and get the score of a text without one. Labels that are null, and rows without
a key, teach nothing; a key labelled twice is toxic if one label says so. Without labels of both kinds the score
is the share of toxic labels (0 without any). Texts are judged whole and alone, so copies and ties score alike;
tables without rows give none; other columns are kept, clashing names of ours get underscores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from basketry.functions.lineage import staged
from basketry.llm.common import free_name, read_table
from basketry.llm.tokens import Recent

FIT_TOXIC, FIT_CLEAN = 6_000, 12_000  # labelled texts to fit on
CANDIDATES, TERMS = 200_000, 5_000  # most frequent terms of toxic texts that are counted; terms in the lexicon
THRESHOLD, WINDOW = 0.3, 8
# Toxic texts that have a term, how much likelier it is in them, and how little by chance (log-likelihood ratio).
LEAST_DOCS, LEAST_LOG_ODDS, LEAST_EVIDENCE = 4, 1.8, 24.0
STEM_LENGTHS = range(4, 9)
LETTERS_FOR_EDIT, STEM_LETTERS_FOR_EDIT = 5, 7
MISSPELT = 0.8  # what an edit leaves of a term's weight
STATES, _START = 200_000, frozenset()  # states of the automaton that a worker keeps; the first one's key

# Cues of reported speech and of address, in four languages.
REPORTED = frozenset(
    "said says wrote writes called calls quoted quote word term slur insult insults meaning "
    "sagte schrieb nannte zitierte wort begriff schimpfwort beleidigung "
    "dit écrit appelle appelé cité mot terme insulte "
    "dijo escribió llamó citó palabra término insulto".split()
)
ADDRESSED = frozenset("you your youre u ur du dich dir deine ihr euch tu toi vous votre tú usted ustedes eres sois".split())
OPENING, CLOSING = "\"“„«‹‘", "\"”“»›’"

_WORD = re.compile(r"[^\W_](?:[^\W_]|[@$!*0-9](?=[^\W_]))*")
_COEFFICIENTS = ("bias", "exact", "dense", "window", "misspelt", "quoted")
# What the coefficients are drawn to, and how strongly.
_PRIOR = np.array([-4.0, 0.5, 0.5, 0.5, 0.6, 0.05])
_PULL = np.array([0.01, 0.5, 0.5, 0.5, 0.5, 0.5])


def words_of(text: str | None) -> list[str]:
    """Lower-case words; signs that stand for letters may be inside of one."""
    return _WORD.findall(text.lower()) if text else []


def edits_of(term: str, stem: bool) -> int:
    """Edits a word may have from the term."""
    least = STEM_LETTERS_FOR_EDIT if stem else LETTERS_FOR_EDIT
    return (len(term) >= least) + (len(term) >= 2 * least - 1)


class State:
    """A set of (trie node, edits so far) that a word's letters lead to, and what they have matched."""

    __slots__ = ("at", "after", "stem", "word")

    def __init__(self, at: dict[int, int], stem: tuple | None, word: tuple | None):
        self.at, self.stem, self.word = at, stem, word
        self.after: dict[str, State | None] = {}


class Lexicon:
    """Terms (term, stem) -> weight in a trie, and the words that only look like them.

    The product of the trie and the Levenshtein automaton is made deterministic state by state, as words need it,
    and kept for the next ones: a word costs one step a letter, and most end in the dead state after a few. When
    STATES are kept, they are made anew.
    """

    def __init__(self, weights: dict[tuple[str, bool], float], innocent: frozenset[str] = frozenset()):
        self.weights, self.innocent = weights, innocent
        self.children: list[dict[str, int]] = [{}]
        self.most: list[int] = [0]  # edits allowed to the terms below a node
        self.terms: list[list[tuple[bool, int, float]]] = [[]]  # (stem, edits, weight)
        for (term, stem), weight in sorted(weights.items()):
            edits, at = edits_of(term, stem), 0
            self.most[0] = max(self.most[0], edits)
            for letter in term:
                if letter not in self.children[at]:
                    self.children[at][letter] = len(self.children)
                    self.children.append({})
                    self.most.append(0)
                    self.terms.append([])
                at = self.children[at][letter]
                self.most[at] = max(self.most[at], edits)
            self.terms[at].append((stem, edits, weight))
        self.states: dict[frozenset, State] = {}

    def __getstate__(self):
        return self.weights, self.innocent

    def __setstate__(self, state):
        self.__init__(*state)

    def _state(self, reached: dict[int, int]) -> State | None:
        """The state of these nodes and of those behind letters that the word lacks; None if there is none."""
        queue = list(reached.items())
        while queue:
            node, edits = queue.pop()
            if reached[node] < edits:
                continue
            for child in self.children[node].values():
                if edits < self.most[child] and edits + 1 < reached.get(child, 99):
                    reached[child] = edits + 1
                    queue.append((child, edits + 1))
        if not reached:
            return None
        key = frozenset(reached.items())
        if key not in self.states:
            ends = [
                (stem, (edits, -weight)) for node, edits in reached.items()
                for stem, most, weight in self.terms[node] if edits <= most
            ]
            self.states[key] = State(
                reached, min((v for stem, v in ends if stem), default=None),
                min((v for stem, v in ends if not stem), default=None),
            )
        return self.states[key]

    def _next(self, state: State, letter: str) -> State | None:
        """Where a letter leads: it is the next one of a term, replaces it, or is one too many."""
        reached: dict[int, int] = {}
        for node, edits in state.at.items():
            for other, child in self.children[node].items():
                now = edits + (other != letter)
                if now <= self.most[child] and now < reached.get(child, 99):
                    reached[child] = now
            if edits < self.most[node] and edits + 1 < reached.get(node, 99):
                reached[node] = edits + 1
        return self._state(reached)

    def look_up(self, word: str) -> tuple[int, float] | None:
        """(edits, weight) of the nearest term, of these the heaviest; None if no term is near enough."""
        if len(self.states) > STATES:
            self.states = {}
        state = self.states.get(_START)
        if state is None:
            state = self.states[_START] = self._state({0: 0})
        best = state.stem
        for letter in word:
            try:
                state = state.after[letter]
            except KeyError:
                after = self._next(state, letter)
                state.after[letter] = after
                state = after
            if state is None:
                break
            if state.stem and (best is None or state.stem < best):
                best = state.stem
        else:
            if state.word and (best is None or state.word < best):
                best = state.word
        return best and (best[0], -best[1])

    def hit(self, word: str) -> tuple[int, float] | None:
        found = self.look_up(word)
        return None if found and found[0] and word in self.innocent else found


class Judge:
    """Features and scores of texts. Look-ups of recent words are kept."""

    def __init__(self, lexicon: Lexicon, coefficients: np.ndarray, kept: int = 200_000):
        self.lexicon, self.coefficients = lexicon, coefficients
        self.known = Recent(lexicon.hit, kept)

    def features(self, text: str | None) -> np.ndarray:
        found = np.zeros(len(_COEFFICIENTS))
        found[0] = 1.0
        if not text:
            return found
        lowered = text.lower()
        hits = list(map(self.known.__getitem__, words := _WORD.findall(lowered)))
        at = [i for i, hit in enumerate(hits) if hit]
        if not at:
            return found
        spans = [m.span() for m in _WORD.finditer(lowered)]
        abuse: list[tuple[int, float]] = []
        exact = misspelt = quoted = 0.0
        for i in at:
            edits, weight = hits[i]
            weight *= MISSPELT**edits
            if self.quoted(lowered, words, spans, i):
                quoted += weight
                continue
            abuse.append((i, weight))
            if edits:
                misspelt += weight
            else:
                exact += weight
        densest = held = 0.0
        first = 0
        for i, weight in abuse:
            held += weight
            while abuse[first][0] < i - 2 * WINDOW:
                held -= abuse[first][1]
                first += 1
            densest = max(densest, held)
        found[1:] = np.log1p([exact, 100 * (exact + misspelt) / len(words), densest, misspelt, quoted])
        return found

    @staticmethod
    def quoted(text: str, words: list[str], spans: list[tuple[int, int]], i: int) -> bool:
        """Whether word i is reported rather than said."""
        low, high = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
        around = words[low:i] + words[i + 1 : high]
        if any(w in ADDRESSED for w in around):
            return False
        before = text[spans[low][0] : spans[i][0]].rpartition("\n")[2]
        after = text[spans[i][1] : spans[high - 1][1] + 1].partition("\n")[0]
        # The text of the window goes on to the sign after its last word.
        for mark, close in zip(OPENING, CLOSING, strict=True):
            opened = before.count(mark) % 2 == 1 if mark == close else before.rfind(mark) > before.rfind(close)
            if opened and close in after:
                return True
        return any(w in REPORTED for w in around)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-(self.features(text) @ self.coefficients))))


@dataclass
class Model:
    """What judges a text; without terms and coefficients every text scores `share`."""

    lexicon: Lexicon
    coefficients: np.ndarray | None
    share: float = 0.0

    def judge(self) -> Judge:
        fixed = min(max(self.share, 1e-9), 1 - 1e-9)
        constant = np.array([math.log(fixed / (1 - fixed)), 0, 0, 0, 0, 0])
        return Judge(self.lexicon, constant if self.coefficients is None else self.coefficients)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int]
) -> tuple[DataFrame, dict[int, float]]:
    """(text, label, fold) of a sample of labelled texts, written once, and what a row of each label stands for.

    Labels are counted and drawn before texts are read; at most about `most` keys of each label are broadcast.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("doc_id").cast("string")), F.lit(1_000_000))
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col("label") == value, min(1.0, most[value] / n)).otherwise(share)
    chosen = staged(known.where(draw < share * 1_000_000), "toxicity-labels")
    texts = (
        docs.select("doc_id", "text").where(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")
        .groupBy(F.xxhash64("text").alias("copy"), "label")
        .agg(F.min_by("text", "doc_id").alias("text"))
        .withColumn("fold", F.pmod(F.col("copy"), F.lit(3)))
    )
    sample = staged(texts.select("text", "label", "fold"), "toxicity-texts")
    return sample, {value: max(1.0, n / most[value]) for value, n in sizes.items()}


_COUNTS = StructType([
    StructField("term", StringType()), StructField("stem", BooleanType()), StructField("n", LongType())
])


def _counted(texts: DataFrame, terms_of) -> DataFrame:
    """(term, stem, n): the texts that have each of the terms that terms_of(words) yields."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out():
            terms, stems = zip(*counts, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(terms), pa.array(stems), pa.array(counts.values(), pa.int64())], _COUNTS.fieldNames()
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(set(terms_of(set(words_of(text)))))
                if len(counts) > 300_000:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return texts.select("text").mapInArrow(run, _COUNTS).groupBy("term", "stem").agg(F.sum("n").alias("n"))


def _terms(words: set[str]) -> Iterator[tuple[str, bool]]:
    for word in words:
        yield word, False
        for length in STEM_LENGTHS:
            if len(word) > length:
                yield word[:length], True


def evidence(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Log-likelihood ratio of a term's counts against one rate for both kinds of texts."""
    def part(n: int, of: int, rate: float) -> float:
        return (n * math.log(n / (of * rate)) if n else 0.0) + (
            (of - n) * math.log((of - n) / (of * (1 - rate))) if of > n else 0.0
        )

    rate = (toxic + clean) / (n_toxic + n_clean)
    return 2 * (part(toxic, n_toxic, rate) + part(clean, n_clean, rate)) if rate < 1 else 0.0


def choose_terms(
    toxic: dict[tuple[str, bool], int], clean: dict[tuple[str, bool], int], n_toxic: int, n_clean: int
) -> dict[tuple[str, bool], float]:
    """Terms that are LEAST_LOG_ODDS likelier in toxic texts, not by chance, with that log-odds as weight.

    A stem is taken where it stands for more texts than any word or longer stem that it covers, the longest of
    equal ones; then what it covers is not.
    """
    weights = {}
    for key, n in toxic.items():
        if n < LEAST_DOCS:
            continue
        odds = math.log((n + 0.5) / (n_toxic + 1)) - math.log((clean.get(key, 0) + 0.5) / (n_clean + 1))
        if odds >= LEAST_LOG_ODDS and evidence(n, clean.get(key, 0), n_toxic, n_clean) >= LEAST_EVIDENCE:
            weights[key] = odds
    longer: dict[str, int] = {}
    for (term, stem) in weights:
        own = toxic[term, stem]
        for length in STEM_LENGTHS:
            if len(term) > length or (len(term) == length and not stem):
                longer[term[:length]] = max(longer.get(term[:length], 0), own)
    stems = {
        term for (term, stem) in weights
        if stem and 0.95 * toxic[term, True] > longer.get(term, 0)
    }
    chosen = {}
    for (term, stem), weight in weights.items():
        if stem and term not in stems:
            continue
        covered = any(term[:k] in stems and weights[term[:k], True] >= weight - 0.7 for k in STEM_LENGTHS if k < len(term))
        if not covered:
            chosen[term, stem] = weight
    order = sorted(chosen, key=lambda k: (-chosen[k] * toxic[k], k))
    return {key: chosen[key] for key in order[:TERMS]}


def fit_lexicon(texts: DataFrame) -> Lexicon:
    """The lexicon of labelled texts (text, label)."""
    sizes = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon({})
    frequent = (
        _counted(texts.where("label = 1"), _terms).where(F.col("n") >= LEAST_DOCS)
        .orderBy(F.desc("n"), "term", "stem").limit(CANDIDATES).collect()
    )
    toxic = {(r["term"], r["stem"]): r["n"] for r in frequent}
    shared = texts.sparkSession.sparkContext.broadcast(frozenset(toxic))  # at most CANDIDATES terms
    plain = _counted(texts.where("label = 0"), lambda words: (t for t in _terms(words) if t in shared.value))
    clean = {(r["term"], r["stem"]): r["n"] for r in plain.collect()}
    lexicon = Lexicon(choose_terms(toxic, clean, sizes[1], sizes[0]))
    given = texts.sparkSession.sparkContext.broadcast(lexicon)

    def near(words: set[str]) -> Iterator[tuple[str, bool]]:
        for word in words:
            found = given.value.look_up(word)
            if found and found[0]:
                yield word, False

    if not lexicon.weights:
        return lexicon
    # Words near a term that are at home in clean texts: bounded by the words of the sampled texts.
    used = {
        label: {r["term"]: r["n"] for r in _counted(texts.where(F.col("label") == label), near).collect()}
        for label in (0, 1)
    }
    innocent = frozenset(
        word for word, n in used[0].items()
        if (used[1].get(word, 0) + 0.5) / (sizes[1] + 1) < math.exp(LEAST_LOG_ODDS) * (n + 0.5) / (sizes[0] + 1)
    )
    return Lexicon(lexicon.weights, innocent)


def fit_coefficients(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards the prior; coefficients of hits stay above nought."""
    beta = _PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (weights * (labels - p)) - _PULL * (beta - _PRIOR)
        bend = (rows * (weights * p * (1 - p))[:, None]).T @ rows + np.diag(_PULL)
        step = np.linalg.solve(bend, slope)
        beta = beta + step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        beta[1:] = np.maximum(beta[1:], 0.0)
    return beta


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """A model from texts (doc_id, text) and labels (doc_id, label)."""
    texts, stands = labelled_texts(docs, labels, label, {0: FIT_CLEAN, 1: FIT_TOXIC})
    if len(stands) < 2:
        return Model(Lexicon({}), None, float(1 in stands))
    lexicon = fit_lexicon(texts.where("fold < 2"))
    model = Model(lexicon, _PRIOR)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([StructField("x", ArrayType(DoubleType())), StructField("label", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value.judge()
        for batch in batches:
            rows = [judge.features(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), batch.column("label")], schema.fieldNames()
            )

    # Six numbers a text, at most FIT_TOXIC + FIT_CLEAN texts; sorted so that sums do not depend on the tasks.
    seen = sorted(map(tuple, texts.where("fold = 2").select("text", "label").mapInArrow(run, schema).collect()))
    if not seen:
        return model
    rows, marks = np.array([x for x, _ in seen]), np.array([y for _, y in seen], float)
    weights = np.where(marks == 1, stands[1], stands[0])
    return Model(lexicon, fit_coefficients(rows, marks, weights))


def judge_toxicity(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD
) -> tuple[DataFrame, dict[str, str]]:
    """The rows of docs with score and predicted (1 from the threshold on), and the names these columns got."""
    names = {"score": free_name(docs, "score")}
    names["predicted"] = free_name(docs.withColumn(names["score"], F.lit(0.0)), "predicted")
    schema = StructType([
        *docs.schema.fields, StructField(names["score"], DoubleType()), StructField(names["predicted"], IntegerType())
    ])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most TERMS terms and the sample's innocent words
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value.judge()
        for batch in batches:
            scores = [judge.score(text.as_py()) for text in batch.column(text_at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                schema.fieldNames(),
            )

    return docs.mapInArrow(run, schema), names


def held_out(key: Column) -> Column:
    """Rows that no model learns from: the remainder of crc32(id as text) by 4 is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").where(~held_out(F.col("doc_id")))
    judged, _ = judge_toxicity(docs, fit(docs, labels))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


QUERIES = {"op13_toxicity": op13_toxicity}
SQL: dict[str, str] = {}
