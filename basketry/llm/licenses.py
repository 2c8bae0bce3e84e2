"""License scans: winnowed template fingerprints pick candidates, banded alignment reports coverage and spans.

Words are runs of letters and digits, lower case. Every template's k-word grams are hashed and winnowed: of each
`window` neighbouring grams the smallest hash is kept, so any k + window - 1 words in a row that a document shares
with a template contain a kept gram. The kept grams form an inverted index from hash to (template, place). A
document's grams are looked up there; hits of one template on nearby diagonals are a candidate region. The region
is aligned with the template in a band around the diagonals of its hits (local alignment: match 2, mismatch and
gap -1). The band is as wide as the words that the coverage lets a match leave out, so no such gap leaves it.
Reported are the template's words matched, their share (coverage) and the span in the document, in words and in
characters.

Null, empty and blank texts match nothing. Templates shorter than k words are indexed as one gram of all their
words. Equal or overlapping templates each report their own match. Repeated rows are scanned each; an empty table
gives no matches. Of docs only doc_id and text are read, so other columns may have any name. Texts of any length are
scanned whole; a stretch with too few of a template's words to reach the coverage is not aligned. The index is bounded by the templates, which are fetched in blocks of BLOCK templates.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from basketry.llm.common import read_table
from basketry.llm.license_texts import TEXTS

GRAM, WINDOW, BAND, COVERAGE, BLOCK = 3, 3, 8, 0.8, 2000
_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x100000001B3)
_ONE = 1 << 32  # a score of one beside counts of words
# The usual short notices of public licenses.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met:"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
     "(at your option) any later version."),
    ("mit", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word grams of a sequence of word numbers; of all its words if it has fewer."""
    k = min(k, len(ids))
    hashes = np.zeros(len(ids) - k + 1, np.uint64)
    for i in range(k):
        hashes = hashes * _BASE + ids[i:len(ids) - k + 1 + i].astype(np.uint64)
    return (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def winnowed(hashes: np.ndarray, window: int) -> list[int]:
    """Places of the smallest hash of every window, the rightmost of equal ones."""
    places = set()
    for at in range(max(1, len(hashes) - window + 1)):
        some = hashes[at:at + window]
        places.add(at + len(some) - 1 - int(some[::-1].argmin()))
    return sorted(places)


def align(template: np.ndarray, words: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(matched, first, end): the best local alignment with places in words minus places in the template from low
    to high; the template words matched and the span of words, first == end if nothing matches.

    A cell's value is its score and, for equal scores, the template words matched; a row of the band is made at once.
    """
    at = np.arange(high - low + 2)
    before, first, end = (np.zeros(len(at), np.int64) for _ in range(3))  # the last cell is beside the band: empty
    best = (0, 0, 0)
    top = _ONE - 1
    for i, word in enumerate(template.tolist()):
        left, right = max(0, -(i + low)), min(len(at) - 1, len(words) - i - low)
        value, starts, ends = (np.zeros(len(at), np.int64) for _ in range(3))
        if left < right:
            own, above = slice(left, right), slice(left + 1, right + 1)
            places = at[own] + (i + low)
            same = words[places] == word
            cells = before[own] + np.where(same, 2 * _ONE + 1, -_ONE)
            begins = np.where(before[own] >= _ONE, first[own], places)
            stops = np.where(same, places + 1, end[own])
            skipped = np.where(before[above] >= _ONE, before[above] - _ONE, 0)
            other = skipped > cells
            cells = np.maximum(np.where(other, skipped, cells), 0)
            begins, stops = np.where(other, first[above], begins), np.where(other, end[above], stops)
            # Skipped words of the document: a cell passes its value on to the right, less one for each step.
            cells[cells < _ONE] = 0
            passed = np.maximum.accumulate(cells + at[own] * _ONE)
            source = np.maximum.accumulate(np.where(cells + at[own] * _ONE == passed, at[own] - left, 0))
            cells = passed - at[own] * _ONE
            cells[cells < _ONE] = 0
            value[own], starts[own], ends[own] = cells, begins[source], stops[source]
            most = int(cells.argmax())
            if cells[most] > top:
                top = int(cells[most])
                best = (top % _ONE, int(begins[source[most]]), int(stops[source[most]]))
        before, first, end = value, starts, ends
    return best


class LicenseIndex:
    """Winnowed grams of templates: hash -> (template, place)."""

    def __init__(self, templates: list[tuple[str, str]], k: int = GRAM, window: int = WINDOW, band: int = BAND):
        self.k, self.band, self.names, self.words = k, band, [], []
        self.numbers: dict[str, int] = {}
        self.index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.sizes: set[int] = set()
        for name, text in templates:
            words = words_of(text)
            if not words:
                continue
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int64)
            hashes = gram_hashes(ids, k)
            self.sizes.add(min(k, len(ids)))
            for place in winnowed(hashes, window):
                self.index[int(hashes[place])].append((len(self.names), place))
            self.names.append(name)
            self.words.append(ids)
        self.keys = np.array(sorted(self.index), np.uint64)
        self.bags = [np.bincount(ids, minlength=len(self.numbers) + 1) for ids in self.words]

    def hits(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, place in the template, place in the document) of the document's grams in the index."""
        found = []
        known = ids > 0
        for k in sorted(self.sizes):
            if len(ids) < k:
                continue
            # Only grams of template words can be in the index.
            whole = np.flatnonzero(np.lib.stride_tricks.sliding_window_view(known, k).all(1))
            if not len(whole):
                continue
            hashes = gram_hashes(ids, k)[whole]
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            for x in np.flatnonzero(self.keys[at] == hashes):
                for template, place in self.index[int(hashes[x])]:
                    found.append((template, place, int(whole[x])))
        return found

    def width(self, template: int, coverage: float) -> int:
        """Half the template's band: as many words as may be left out of it, at least the given band."""
        return max(self.band, int((1 - coverage) * len(self.words[template])))

    def scan(self, text: str | None, coverage: float) -> list[tuple[int, int, float, int, int, int, int]]:
        """(template, matched, coverage, first word, end word, first character, end character) of the matches."""
        words = words_of(text)
        get = self.numbers.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        if not len(ids) or not ids.any():
            return []
        regions: dict[int, list[list[int]]] = defaultdict(list)
        for template, place, at in sorted(self.hits(ids), key=lambda h: (h[0], h[2] - h[1])):
            start, some = at - place, regions[template]
            # Hits that begin their template at nearby words are one region.
            if some and start - some[-1][1] <= self.width(template, coverage):
                some[-1][1] = start
            else:
                some.append([start, start])
        found = []
        for template, some in regions.items():
            own, band = self.words[template], self.width(template, coverage)
            for low, high in some:
                for first_start in range(low, high + 1, band + 1):
                    last = min(high, first_start + band)
                    begin, stop = max(0, first_start - 2 * band), last + len(own) + 2 * band
                    found += self._aligned(template, ids, begin, stop, first_start - band, last + band, coverage)
        return self._placed(text, found)

    def _aligned(
        self, template: int, ids: np.ndarray, begin: int, stop: int, low: int, high: int, coverage: float
    ) -> list[tuple[int, int, float, int, int]]:
        """Matches in the words from begin to stop on the diagonals from low to high, the best one first and then
        those beside it: a notice may be repeated within the band."""
        own, found, open_ = self.words[template], [], [(begin, min(stop, len(ids)))]
        while open_:
            begin, stop = open_.pop()
            if stop - begin < coverage * len(own):
                continue
            # No more words can match than the stretch has of the template's.
            there = np.bincount(ids[begin:stop], minlength=len(self.numbers) + 1)[:len(self.numbers) + 1]
            if np.minimum(there, self.bags[template]).sum() < coverage * len(own):
                continue
            matched, first, end = align(own, ids[begin:stop], low - begin, high - begin)
            if matched >= coverage * len(own) and end > first:
                found.append((template, matched, matched / len(own), begin + first, begin + end))
                open_ += [(begin, begin + first), (begin + end, stop)]
        return found

    def _placed(self, text: str, found: list) -> list:
        if not found:
            return []
        best = {}
        for match in sorted(found, key=lambda m: (m[0], -m[1], m[3])):
            if not any(m[0] == match[0] and m[3] < match[4] and match[3] < m[4] for m in best.values()):
                best[match[0], match[3]] = match
        lowered = text.lower()
        spans = [m.span() for m in _WORD.finditer(lowered)]
        if len(lowered) != len(text):  # letters that lower-casing writes as several
            origin = [i for i, c in enumerate(text) for _ in c.lower()]
            spans = [(origin[first], origin[end - 1] + 1) for first, end in spans]
        return [(*m, spans[m[3]][0], spans[m[4] - 1][1]) for m in sorted(best.values())]


def scan_licenses(
    docs: DataFrame, templates: DataFrame, k: int = GRAM, window: int = WINDOW, band: int = BAND,
    coverage: float = COVERAGE, block: int = BLOCK,
) -> DataFrame:
    """(doc_id, template, matched_words, coverage, first_word, end_word, first_char, end_char) of the matches of
    templates (template, text) in docs, of at least the given coverage."""
    schema = StructType([
        StructField("doc_id", LongType()), StructField("template", StringType()),
        StructField("matched_words", IntegerType()), StructField("coverage", DoubleType()),
        *[StructField(n, IntegerType()) for n in ("first_word", "end_word", "first_char", "end_char")],
    ])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = docs.sparkSession.createDataFrame([], schema)
    kept = templates.select("template", "text").where("text is not null")
    blocks = max(1, math.ceil(kept.count() / block))
    part = F.pmod(F.xxhash64("template", "text"), F.lit(blocks))
    for b in range(blocks):
        some = sorted(map(tuple, kept.where(part == b).collect()), key=repr)
        if not some:
            continue

        def run(batches, some=some):
            index = LicenseIndex(some, k, window, band)
            for batch in batches:
                out = [
                    (i, index.names[m[0]], *m[1:])
                    for i, t in enumerate(batch.column("text").to_pylist()) for m in index.scan(t, coverage)
                ]
                if out:
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").take(pa.array(columns[0])), pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.float64()),
                        *[pa.array(c, pa.int32()) for c in columns[4:]],
                    ], schema.fieldNames())

        found = found.union(rows.mapInArrow(run, schema))
    return found


def known_templates(spark: SparkSession) -> DataFrame:
    """(template, text) of the short notices and the full texts of public licenses."""
    return spark.createDataFrame([*NOTICES, *TEXTS], "template string, text string")


def op1_licenses(spark: SparkSession, folder: str, templates: DataFrame | None = None) -> DataFrame:
    """Matches in documents of the given templates, by default the known ones."""
    if templates is None:
        templates = known_templates(spark)
    return scan_licenses(read_table(spark, folder, "documents"), templates)


QUERIES = {"op1_licenses": op1_licenses}
SQL: dict[str, str] = {}
