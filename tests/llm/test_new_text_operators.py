"""Fill-in-middle, spelling variants and toxicity against SQL, brute force and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import infill, toxicity, variants

DOCS = "doc_id bigint, text string, lang string, N int, form string, output string, word string, score double"
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["naïve", "word", "北京", "🙂x", "colour", "color"]) for _ in range(60_000))
    texts = [
        (1, "one two  three\tfour "), (1, "one two  three\tfour "), (2, None), (3, ""), (4, " \n\t "),
        (None, "no id here but text"), (None, None), (5, long), (6, long + " tail"), (7, "a <P> b"), (8, "é" * 50_000),
        (9, "Ärger ünd Straße — ﬁn d 🙂 𝒳 \x1c x"), (10, "<" * 40), (11, "z" * 200_000), (12, "z" * 200_000 + "q"),
    ]
    return spark.createDataFrame([(*r, None, 1, "f", "o", "w", None) for r in texts], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_infill(key, text, unit="token"):
    text = text or ""
    h = [int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = TOKEN.findall(text) if unit == "token" else list(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", ["token", "char"])
def test_infill_equals_brute_force(odd, unit):
    made, names = infill.fill_in_middle(odd, unit=unit)
    assert made.columns[: len(odd.columns)] == odd.columns and len(set(map(str.lower, made.columns))) == len(made.columns)
    rows = made.withColumn("back", infill.restored(F.col(names["output"]), F.col(names["form"]))).collect()
    assert len(rows) == odd.count()
    for r in rows:
        want = brute_infill(r["doc_id"], r["text"], unit)
        assert tuple(r[names[c]] for c in ("n", "form", "prefix_chars", "middle_chars", "output")) == want
        assert r["back"] == (r["text"] or "")


def test_infill_of_many_keys_takes_every_form(spark):
    rng = random.Random(1)
    texts = [(i, "".join(rng.choice("ab é北🙂\n\t ") for _ in range(rng.randrange(30)))) for i in range(2000)]
    rows = infill.fill_in_middle(spark.createDataFrame(texts, "doc_id bigint, text string"))[0].collect()
    assert [tuple(r)[2:] for r in rows] == [brute_infill(*t) for t in texts]
    assert min(Counter(r["form"] for r in rows).values()) > 100


def test_exception_index():
    text = "aé北🙂b" * 50 + "plain"
    index = infill.Exceptions(np.frombuffer(text.encode(), np.uint8))
    ends = np.cumsum([0, *(len(c.encode()) for c in text)])
    assert index.chars == len(text) and [index.to_byte(i) for i in range(len(text) + 1)] == ends.tolist()
    assert [index.to_char(int(b)) for b in ends] == list(range(len(text) + 1))
    assert len(infill.Exceptions(np.frombuffer(b"ascii only", np.uint8)).at) == 0


def test_infill_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.sql(f"create view documents as from '{folder}/documents.parquet'")
    got = infill.op11_infill(spark, folder)
    want = con.sql(f"select {', '.join(got.columns)} from ({infill.OP11_SQL})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_infill_empty(empty):
    made, _ = infill.fill_in_middle(empty)
    assert made.count() == 0


# Spelling variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, stronger=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        if found:
            best = min(found, key=lambda v: (-counts[v], v))
            if counts[best] >= stronger * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items())


def test_variants_equal_brute_force(spark):
    rng = random.Random(2)
    counts = {}
    for _ in range(700):  # few letters: runs of equal ones, many near words, ties
        counts["".join(rng.choice("abé") for _ in range(rng.randrange(5, 9)))] = 2 ** rng.randrange(8)
    tail = "x" * 70
    for w in ("", "a", "ab", "aab", "b", "ba"):  # words whose rotations are digests
        counts[w + tail] = rng.randrange(1, 40)
        counts[tail + w] = rng.randrange(1, 40)
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(5)
    got = sorted((tuple(r) for r in variants.spelling_variants(words).collect()), key=lambda r: r[0])
    assert got == brute_variants(counts)
    assert max(r[4] for r in got) > 8


def test_rotations_of_a_very_long_word():
    rows = list(variants.rotations("ab" * 50_000))
    assert len(rows) == 2 * 100_000 + 1 and max(len(k) for k, _ in rows) == 33


def test_word_counts_odd_rows(odd, empty):
    got = {r["word"]: r["n"] for r in variants.word_counts(odd, least_count=1).collect()}
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    want = Counter(w for r in odd.collect() for w in re.findall("[A-Za-zÀ-ÿ]+", low(r["text"])) if len(w) >= 5)
    assert got == want and got["naïve"] > 1000
    rows = variants.spelling_variants(variants.word_counts(odd)).collect()
    assert {r["word"]: r["form"] for r in rows}.keys() == {w for w, n in want.items() if n >= 3}
    assert variants.spelling_variants(variants.word_counts(empty)).count() == 0


def test_long_copies_of_one_run_are_near(spark):
    rows = [(i, "z" * 30_000 + "q" * (i % 3 == 0)) for i in range(12)]
    words = variants.word_counts(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {len(r["word"]): (r["n"], r["n_near"], r["form"] and len(r["form"])) for r in variants.spelling_variants(words).collect()}
    assert got == {30_000: (8, 1, None), 30_001: (4, 1, 30_000)}


def test_variants_query_equals_brute_force(spark, folder):
    con = duckdb.connect()
    counts = Counter()
    for key, text in con.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{key}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    got = sorted((tuple(r) for r in variants.op12_variants(spark, folder).collect()), key=lambda r: r[0])
    assert got == brute_variants(counts)


# Toxicity


def distance(term, word, stem):
    row = list(range(len(word) + 1))
    for i, a in enumerate(term, 1):
        row, before = [i], row
        for j, b in enumerate(word, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return min(row) if stem else row[-1]


def test_automaton_equals_levenshtein_distance():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 13)))
    for _ in range(12):
        weights = {(word(), rng.random() < 0.3): rng.randrange(1, 50) / 7 for _ in range(25)}
        lexicon = toxicity.Lexicon(weights)
        for _ in range(300):
            w = word()
            near = [(d, -v) for (t, s), v in weights.items() if (d := distance(t, w, s)) <= toxicity.edits_of(t, s)]
            found = lexicon.look_up(w)
            assert (found and (found[0], -found[1])) == min(near, default=None), (w, weights)


CLEAN = "the of and to in a is that for it was on are with as his they at be this from have or one".split()
BAD = ("idiotic", "worthless", "disgusting")


def toxic_corpus(n=900):
    """Every third text has terms, a quarter of these quote them and are no abuse."""
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(CLEAN) + rng.choice(["", "s", "ly"]) for _ in range(40)]
        label = 0
        if i % 3 == 0:
            at, quoted = rng.randrange(5, 30), i % 12 == 0
            for bad in rng.sample(BAD, 2):
                words[at:at] = ['he said', f'"{bad}"'] if quoted else [bad]
            label = int(not quoted)
        docs.append((i, " ".join(words)))
        labels.append((i, label, 0))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = toxic_corpus()
    return toxicity.fit(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int"),
    )


def test_lexicon_holds_the_terms(fitted):
    assert {t for t, _ in fitted.lexicon.weights} == set(BAD)


def test_misspelt_terms_and_quotations(fitted):
    judge = fitted.judge()
    plain = " ".join(CLEAN)
    high = [f"{plain} {w} worthless {plain}" for w in ("idiotic", "idi0tic", "idioticc", "idotic")]
    low = [
        plain, "", None, " \n ", f'{plain} he said "idiotic" {plain}', f"{plain} « worthless » {plain}",
        f"{plain} the word idiotic {plain}",
    ]
    assert min(map(judge.score, high)) >= toxicity.THRESHOLD > max(map(judge.score, low))
    assert judge.score(f'{plain} "you worthless idiotic" {plain}') >= toxicity.THRESHOLD


def test_toxicity_odd_rows(fitted, odd, empty, spark):
    judged, names = toxicity.judge_toxicity(odd, fitted)
    assert names == {"score": "score_", "predicted": "predicted"}
    assert judged.where(F.col("score_").between(0, 1)).count() == odd.count() and judged.columns[:8] == odd.columns
    assert toxicity.judge_toxicity(empty, fitted)[0].count() == 0
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1)], "doc_id bigint, toxic int, quality int")
    assert toxicity.judge_toxicity(odd, toxicity.fit(odd, labels))[0].where("predicted = 1 or score_ > 0.01").count() == 0
    one = spark.createDataFrame([(1, 1, 1)], "doc_id bigint, toxic int, quality int")
    assert toxicity.judge_toxicity(odd, toxicity.fit(odd, one))[0].where("predicted = 0").count() == 0
    assert toxicity.judge_toxicity(empty, toxicity.fit(empty, labels.limit(0)))[0].count() == 0


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    rows = toxicity.op13_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    tally = defaultdict(int)
    for r in rows:
        if r["held_out"] and r["toxic"] is not None:
            tally[r["toxic"], r["predicted"]] += 1
    assert tally[1, 1] / (tally[1, 1] + tally[1, 0]) > 0.9
    assert tally[0, 0] / (tally[0, 0] + tally[0, 1]) > 0.98
