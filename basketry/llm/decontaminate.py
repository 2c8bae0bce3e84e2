"""Benchmark decontamination: edit-similar passages by CGK embedding, bit-sampling LSH and exact verification.

Texts and items are sequences of words (runs of letters and digits, lower case). An item leaks where some run
of words of the document is within floor((1 - similarity) * item words) edits of it.

For every item length, windows of that length slide over every position of every document. A window is embedded
by CGK: a walk that writes the current word and moves on or stays by a random bit of (step, word), so that few
edits become few differing places. Repetitions sample places of embeddings with walks of their own; a window
and an item that agree in all sampled places of a repetition are a candidate. The number of repetitions has no
bound and comes from the recall wanted: for every item length it is measured, on the items themselves with the
largest allowed number of random edits, how often a repetition agrees, item by item, so that those with poor
agreement count as what they miss. Long items agree less often and get fewer places instead of ever more
repetitions; where even one place does not reach the recall, every window is a candidate. Neighbouring candidates
are verified together by exact edit distance over the words around them, which also gives the span; the words
left and right of a leak are searched again.

Windows without enough of the items' word pairs cannot be within the edits allowed and are not embedded: each
edit breaks at most two of the item's neighbouring pairs. Where edits may break all pairs, every window is
embedded. Items are indexed once, in blocks of a fixed number.

Null and empty texts have no leaks; an item without words, or null, leaks nowhere. Repeated rows are searched
each; repeated items are reported by each item_id. Of leaks that overlap, the one with the fewest edits is
reported, of equal ones the first. An empty table on either side gives no leaks. Whole texts are searched,
however long; find_leaks ignores other columns of both tables, drop_leaked returns those of docs as they are.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from basketry.llm.common import read_table

SIMILARITY, RECALL, SAMPLES, BLOCK = 0.8, 0.98, 3, 5000
# Repetitions from which fewer places are tried; trials and repetitions of the measurement.
_DEAR, _SEED, _TRIALS, _PROBES = 24, 20240229, 100, 192
_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def walk_samples(words: np.ndarray, places: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Keys of the sampled places of the CGK embeddings.

    words: windows x length word numbers. places: repetitions x samples steps of the walk. factors: repetitions
    x steps odd numbers, the random bits of a step being a hash of its factor and the word.
    Returns repetitions x windows keys. A walk past the end writes a sign of its own.
    """
    repeats, length = places.shape[0], words.shape[1]
    padded = np.concatenate([words, np.full((len(words), 1), -1)], 1).astype(np.uint64)
    row = np.arange(len(words))[None, :]
    at = np.zeros((repeats, len(words)), np.int64)
    keys = np.zeros((repeats, len(words)), np.uint64)
    for step in range(int(places.max()) + 1):
        word = padded[row, np.minimum(at, length)]
        for chosen in np.flatnonzero((places == step).any(1)):
            keys[chosen] = (keys[chosen] ^ (word[chosen] + np.uint64(1))) * _MIX
        mixed = (word + np.uint64(7)) * factors[:, step, None]
        at += ((mixed >> np.uint64(40)) & np.uint64(1)).astype(np.int64)
    return keys


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """The words after so many random edits, cut or filled to their length with words no item has."""
    out = list(words)
    for _ in range(edits):
        at, kind = int(rng.integers(0, max(1, len(out)))), int(rng.integers(0, 3))
        new = -int(rng.integers(1, 1 << 40))
        if kind == 0 and out:
            out[at] = new
        elif kind == 1:
            out.insert(at, new)
        elif out:
            del out[at]
    size = len(words)
    return np.array((out + [-int(rng.integers(1, 1 << 40)) for _ in range(size)])[:size], np.int64)


def repeats_needed(agree: np.ndarray, recall: float) -> int | None:
    """Repetitions after which the trials (rows) have agreed once with probability `recall`; None: too many to
    tell from these trials."""
    miss = 1 - agree.mean(1)
    if (miss == 1).mean() > 1 - recall:
        return None
    low, high = 0, 1
    while (miss**high).mean() > 1 - recall:
        low, high = high, 2 * high
    while high - low > 1:
        half = (low + high) // 2
        low, high = (half, high) if (miss**half).mean() > 1 - recall else (low, half)
    return high


class LengthIndex:
    """Items of one length: the tables of all repetitions, `repeats` of them; none: every window is a candidate."""

    def __init__(self, length: int, items: list[tuple[int, np.ndarray]], edits: int, recall: float, samples: int):
        self.length, self.edits = length, edits
        # Pairs of the item that an occurrence keeps in the window at its start: every edit breaks two at most,
        # and an insertion may push one more out.
        self.least = length - 1 - 3 * edits
        self.numbers = np.array([i for i, _ in items])
        matrix = np.stack([w for _, w in items])
        self.repeats: int | None = 1
        self._draw(samples, 1)
        if edits:
            rng = np.random.default_rng(_SEED + length)
            some = matrix[rng.integers(0, len(matrix), _TRIALS)]
            changed = np.stack([edited(w, edits, rng) for w in some])
            for places in range(samples, 0, -1):
                self._draw(places, _PROBES)
                self.repeats = repeats_needed((self.keys(some) == self.keys(changed)).T, recall)
                if self.repeats is not None and self.repeats <= _DEAR:
                    break
            if self.repeats is None:
                return
            self._draw(places, self.repeats)
        keys = self.keys(matrix)
        self.order = np.argsort(keys, axis=1)
        self.sorted = np.take_along_axis(keys, self.order, 1)

    def _draw(self, samples: int, repeats: int) -> None:
        """Places and random bits of so many repetitions, the same ones for fewer or more."""
        rng = np.random.default_rng((_SEED, self.length, samples))
        # Late steps of a walk differ more after an early edit; places are drawn from the first two thirds.
        drawn = [(rng.integers(0, 2 * self.length, samples), rng.integers(1, 1 << 62, 3 * self.length)) for _ in range(repeats)]
        self.places = np.sort(np.stack([p for p, _ in drawn]), axis=1)
        self.factors = np.stack([f for _, f in drawn]).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, words: np.ndarray) -> np.ndarray:
        return walk_samples(words, self.places, self.factors)

    def candidates(self, windows: np.ndarray) -> list[tuple[int, int]]:
        """(window, item) of the windows and items that agree in a repetition, in order."""
        if self.repeats is None:
            return [(w, int(i)) for w in range(len(windows)) for i in np.sort(self.numbers)]
        found: set[tuple[int, int]] = set()
        keys = self.keys(windows)
        for r in range(self.repeats):
            low = np.searchsorted(self.sorted[r], keys[r], "left")
            high = np.searchsorted(self.sorted[r], keys[r], "right")
            for w in np.flatnonzero(high > low).tolist():
                found.update((w, i) for i in self.numbers[self.order[r, low[w]:high[w]]].tolist())
        return sorted(found)


def best_span(item: np.ndarray, words: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the run of words nearest to the item, the earliest end of equal ones; None if it is
    more than `most` edits away."""
    def ends(a: np.ndarray, b: np.ndarray, free: bool) -> np.ndarray:
        steps = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, np.int64) if free else steps.copy()
        for i, word in enumerate(a):
            new = np.empty_like(row)
            new[0] = i + 1
            new[1:] = np.minimum(row[:-1] + (b != word), row[1:] + 1)
            row = np.minimum.accumulate(new - steps) + steps
        return row

    if np.isin(item, words).sum() < len(item) - most:
        return None
    last = ends(item, words, True)
    end = int(last.argmin())
    if last[end] > most:
        return None
    back = ends(item[::-1], words[:end][::-1], False)
    return int(last[end]), end - int(np.flatnonzero(back == last[end])[0]), end


class Searcher:
    """Leaks of a block of items in texts."""

    def __init__(self, items: list[tuple[int | None, str | None]], similarity: float, recall: float, samples: int):
        self.numbers: dict[str, int] = {}
        self.items, by_length = [], defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)
            ids = np.array([self.numbers[w] for w in words], np.int64)
            by_length[len(ids)].append((len(self.items), ids))
            self.items.append((item_id, ids))
        self.indexes = []
        for length, some in sorted(by_length.items()):
            edits = math.floor((1 - similarity) * length + 1e-9)
            self.indexes.append(LengthIndex(length, some, edits, recall, samples))
        # Neighbouring words of the items, and which item lengths have them.
        own = [np.unique(np.concatenate([w[:-1] << 32 | w[1:] for _, w in by_length[i.length]])) for i in self.indexes]
        self.pairs = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
        self.has = np.zeros((len(own), len(self.pairs)), bool)
        for row, pairs in zip(self.has, own, strict=True):
            row[np.searchsorted(self.pairs, pairs)] = True
        self.least = np.array([i.least for i in self.indexes])

    def numbered(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        get = self.numbers.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def found_pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which a pair of the items begins, and the pairs' places in self.pairs."""
        if len(ids) < 2 or not len(self.pairs):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        some = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        pair = ids[some] << 32 | ids[some + 1]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        same = self.pairs[at] == pair
        return some[same], at[same]

    def starts(self, row: int, ids: np.ndarray, places: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Positions at which a window may be near an item of this length."""
        index = self.indexes[row]
        if index.length == 1:
            return np.flatnonzero(ids > 0)
        sums = np.zeros(len(ids) + 1, np.int64)
        sums[places[self.has[row, pairs]] + 1] = 1
        sums = np.cumsum(sums)
        first = np.arange(max(1, len(ids) - index.length + index.edits + 1))
        last = np.minimum(first + index.length - 1, len(ids))
        return first[sums[last] - sums[first] >= index.least]

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, first word, end word) of every leak."""
        ids: dict[int, np.ndarray] = {}
        places: list[list[tuple[int, np.ndarray]]] = [[] for _ in self.indexes]
        for t, text in enumerate(texts):
            numbered = self.numbered(text)
            at, pairs = self.found_pairs(numbered)
            enough = self.has[:, pairs].sum(1) >= self.least
            if self.indexes and self.indexes[0].length == 1:
                enough[0] = True
            for row in np.flatnonzero(enough):
                starts = self.starts(row, numbered, at, pairs)
                if len(starts):
                    ids[t] = numbered
                    places[row].append((t, starts))
        leaks = []
        for index, some in zip(self.indexes, places, strict=True):
            for low in range(0, len(some), 64):
                leaks += self._verified(index, some[low:low + 64], ids)
        return leaks

    def _verified(self, index: LengthIndex, places: list, ids: dict[int, np.ndarray]) -> list[tuple]:
        length, windows, owner = index.length, [], []
        for t, starts in places:
            filled = np.concatenate([ids[t], np.full(length, -1)])
            windows.append(np.lib.stride_tricks.sliding_window_view(filled, length)[starts])
            owner += [(t, s) for s in starts.tolist()]
        tried = defaultdict(list)
        for w, item in index.candidates(np.concatenate(windows)):
            text, start = owner[w]
            tried[text, item].append(start)
        leaks = []
        for (text, item), starts in tried.items():
            words, some = ids[text], self.items[item][1]
            # Windows whose surroundings overlap are verified as one stretch of words.
            stretches: list[list[int]] = []
            for start in sorted(starts):
                low, high = max(0, start - index.edits), min(len(words), start + length + index.edits)
                if stretches and low <= stretches[-1][1]:
                    stretches[-1][1] = high
                else:
                    stretches.append([low, high])
            while stretches:
                low, high = stretches.pop()
                span = best_span(some, words[low:high], index.edits) if high - low >= length - index.edits else None
                if span:
                    edits, a, b = span
                    leaks.append((text, item, edits, low + a, low + b))
                    stretches += [[low, low + a], [low + b, high]]
        return leaks


def item_blocks(items: DataFrame, block: int) -> list[list[tuple]]:
    """Items in lists of about `block`, each list fetched alone."""
    kept = items.select("item_id", "text").where(F.col("text").isNotNull())
    blocks = max(1, math.ceil(kept.count() / block))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    fetched = (sorted(map(tuple, kept.where(part == b).collect()), key=repr) for b in range(blocks))
    return [x for x in fetched if x]


def searchers(items: DataFrame, similarity: float, recall: float, samples: int, block: int) -> list:
    """The broadcast index of each block of items, bounded by the block."""
    context = items.sparkSession.sparkContext
    return [context.broadcast(Searcher(some, similarity, recall, samples)) for some in item_blocks(items, block)]


def find_leaks(
    docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
    samples: int = SAMPLES, block: int = BLOCK,
) -> DataFrame:
    """(doc_id, item_id, edits, similarity, first_word, end_word) of every leak of items (item_id, text) in docs."""
    schema = StructType([
        StructField("doc_id", LongType()), StructField("item_id", LongType()), StructField("edits", IntegerType()),
        StructField("similarity", DoubleType()), StructField("first_word", LongType()),
        StructField("end_word", LongType()),
    ])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = docs.sparkSession.createDataFrame([], schema)
    for shared in searchers(items, similarity, recall, samples, block):
        def run(batches, shared=shared):
            searcher = shared.value
            for batch in batches:
                leaks = searcher.search(batch.column("text").to_pylist())
                if leaks:
                    text, item, edits, first, end = (list(x) for x in zip(*leaks, strict=True))
                    size = [len(searcher.items[i][1]) for i in item]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").take(pa.array(text)),
                        pa.array([searcher.items[i][0] for i in item], pa.int64()), pa.array(edits, pa.int32()),
                        pa.array([1 - e / n for e, n in zip(edits, size, strict=True)], pa.float64()),
                        pa.array(first, pa.int64()), pa.array(end, pa.int64()),
                    ], schema.fieldNames())

        found = found.union(rows.mapInArrow(run, schema))
    return found


def drop_leaked(
    docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
    samples: int = SAMPLES, block: int = BLOCK,
) -> DataFrame:
    """The rows of docs in which no item leaks, with their columns as they are."""
    kept = docs
    for shared in searchers(items, similarity, recall, samples, block):
        def run(batches, shared=shared):
            searcher = shared.value
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[x[0] for x in searcher.search(batch.column("text").to_pylist())]] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(run, docs.schema)
    return kept


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


QUERIES = {"op3_decontaminate": op3_decontaminate}
SQL: dict[str, str] = {}
