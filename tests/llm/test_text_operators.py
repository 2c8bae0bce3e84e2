"""Packing, SimHash, decontamination, language ID, pseudonyms and license scans against brute force and odd rows."""

import random
import re
import sys
import time
import zlib
from collections import Counter, defaultdict
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from basketry.llm import components, decontaminate, langid, licenses, packing, pii, simhash
from basketry.llm.tokens import TextEncoder, text_encoder, tokenizer_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, Row string, fp_ int"
WORDS = "the of and to in a is that for it was on are as with his they at be this from have or one had".split()


def made(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    long = made(1, 20_000)
    rows = [
        (1, "one two three four", "en", "a", 3, "x", 1), (1, "one two three four", "en", "a", 3, "x", 1),
        (2, None, None, None, None, None, None), (3, "", "en", "", 0, "", 0), (4, " \n\t ", "en", "b", 1, "", 2),
        (None, "no id here but text", "fr", "a", 1, None, 0), (5, long, "en", "a", 1, "x", 0),
        (6, long + " tail", "en", None, 1, "x", 0), (7, "!!! *** 123", "de", "c", 1, "x", 0),
        (8, "Ärger İstanbul naïve d'été don't STOP <|endoftext|> ﬁ", "de", "c", 1, "x", 0),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_token_ids_equal_the_tokenizers():
    path = tokenizer_path("word_bpe_49k.json")
    plain, ours = Tokenizer.from_file(path), text_encoder(path)
    texts = [
        "", " ", "Don't STOP 'Ll x'y''s  <|endoftext|>a", "İstanbul ß ﬁ \x1c é ́a K Å 12a3 _a_", made(3, 300),
        "l'été's « ça » 北京 हिन्दी 🙂🙂 a b c", "ÀÉÎ Œuvre straße;naïve--x 9½ ²",
    ]
    for text in texts:
        got = np.frombuffer(ours.ids(text.encode()), ours.dtype).tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids, text


def test_columns_are_encoded_by_distinct_words():
    path = tokenizer_path("word_bpe_49k.json")
    plain, ours = Tokenizer.from_file(path), TextEncoder(path)
    texts = [
        None, "", " ", "Don't STOP 'Ll x'y''s  <|endoftext|>a", "İstanbul ß ﬁ \x1c é ́a K Å 12a3 _a_\x85b\xa0c", "北京",
        "l'été's « ça » हिन्दी 🙂🙂 a b c\n\n\td\x0b\x0ce\r", " ÀÉÎ Œuvre straße;naïve--x 9½ ² ", made(3, 3000), made(3, 3000), "",
    ]
    raw = [None if t is None else t.encode() for t in texts] + [b"broken \xff\xc3 text"]
    column = pa.array([b"cut off", *raw, b"cut off"], pa.binary()).slice(1, len(raw))
    ids, ends = ours.column(column)
    for k, (text, low, high) in enumerate(zip(raw, [0, *ends[:-1]], ends, strict=True)):
        want = plain.encode((text or b"").decode("utf-8", "replace"), add_special_tokens=False).ids
        assert ids[low:high].tolist() == want, k
    nothing, none = ours.column(pa.array([], pa.binary()))
    blank, ends = ours.column(pa.array([None, b"", b" "], pa.binary()))
    assert len(nothing) == len(none) == len(blank) == 0 and ends.tolist() == [0, 0, 0]
    # Other tokenizers encode each distinct word once as well.
    path = tokenizer_path("byte_bpe_50k.json")
    other, asked = TextEncoder(path), Counter()
    piece = other.pieces.make
    other.pieces.make = lambda word: asked.update([word]) or piece(word)
    ids, ends = other.column(column)
    assert [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)] == [TextEncoder(path).ids(t) for t in raw]
    assert set(asked.values()) == {1}


def test_packing_looks_up_no_word_of_plain_text_alone():
    texts = [made(k, 500).encode() for k in range(20)]
    ours = text_encoder(tokenizer_path(packing.TOKENIZER), packing.KEPT_PARTS)
    words, ours.pieces.make = [], lambda word: words.append(word) or b""
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(20)), pa.array(["=a"] * 20), pa.array(texts, pa.binary())], ["doc_id", "queue", "text"]
    )
    rows = sum(len(ours.column(x.column("text"))[1]) for x in packing.slices(batch, "text", 4000))
    assert rows == 20 and not words


def test_packing_leaves_workers_their_memory():
    rows = [b"x" * n for n in (3 << 20, 0, 3 << 20, 3 << 20, 20 << 20, 5, 1 << 20)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["text"])
    parts = [x.column("text").to_pylist() for x in packing.slices(batch, "text", 8 << 20)]
    assert [t for part in parts for t in part] == rows
    assert len(parts) > 2 and all(sum(len(t or b"") for t in p[1:]) < 8 << 20 for p in parts)
    assert list(packing.slices(batch.slice(0, 0), "text")) == []
    # What stays in a worker after half a million distinct words, of the 118 MB that words and their parts took.
    ours = TextEncoder(tokenizer_path(packing.TOKENIZER), packing.KEPT_PARTS)
    letters = str.maketrans("0123456789", "abcdefghij")
    for low in range(0, 500_000, 50_000):
        ours.column(pa.array([" ".join(map(str, range(low, low + 50_000))).translate(letters).encode()], pa.binary()))
    kept = [ours.parts, ours.parts.older, ours.pieces, ours.pieces.older]
    held = sum(sys.getsizeof(d) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in d.items()) for d in kept)
    assert held < 60e6


def check_pieces(rows, docs, window=packing.WINDOW):
    plain = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    whole = defaultdict(int)
    for r in docs:
        whole[tuple(plain.encode(r["text"] or "", add_special_tokens=False).ids + [2])] += 1
    by_doc, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"] > 0
    assert sum(r["length"] for r in rows) == sum(len(k) * n for k, n in whole.items())
    sizes = []
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        sizes.append(at)
    assert sorted(windows) == list(range(len(windows)))
    assert sum(s < window for s in sizes) <= 1 and max(sizes, default=0) <= window
    return by_doc


@pytest.mark.parametrize("targets", [None, {"a": 0.7, "b": 0.2, None: 0.1}])
def test_packing_odd_rows(odd, targets):
    pieces = packing.pack_documents(odd, tokenizer_path(packing.TOKENIZER), targets).collect()
    check_pieces(pieces, odd.collect())
    nulls = [p for p in pieces if p["doc_id"] == 2]
    assert [(p["length"], p["doc_tokens"], p["source"]) for p in nulls] == [(1, 1, None)]


def test_packing_hits_the_targets(spark):
    rows = [(i, made(i, 400), "en", "ab"[i % 2], 1, "x", 0) for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    pieces = packing.pack_documents(docs, tokenizer_path(packing.TOKENIZER), {"a": 0.75, "b": 0.25}).collect()
    by_doc = check_pieces(pieces, docs.collect())
    for parts in by_doc.values():
        parts.sort(key=lambda r: r["start"])
        assert sum(r["length"] for r in parts) == parts[0]["doc_tokens"]
        assert all(a["start"] + a["length"] == b["start"] for a, b in zip(parts, parts[1:], strict=False))
    mix = defaultdict(lambda: defaultdict(int))
    for r in pieces:
        mix[r["sequence_id"]][r["source"]] += r["length"]
    both = [m for m in mix.values() if m["b"] and m["a"]]
    full = [m for m in both if sum(m.values()) == packing.WINDOW]
    # Until a queue runs dry every window has its share to the token.
    assert sum(abs(m["a"] - 3072) <= 1 for m in full) >= len(full) - 1


def test_rare_sources_are_not_cut_to_crumbs(spark):
    rows = [(i, made(i, 3000), "en", "big", 1, "x", 0) for i in range(60)] + [(900, made(900, 500), "en", "rare", 1, "x", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    pieces = packing.pack_documents(docs, tokenizer_path(packing.TOKENIZER)).where("source = 'rare'").collect()
    assert sum(p["length"] for p in pieces) == pieces[0]["doc_tokens"]
    assert len(pieces) <= pieces[0]["doc_tokens"] / packing.LEAST + 2


def test_packing_empty(empty):
    assert packing.pack_documents(empty, tokenizer_path(packing.TOKENIZER)).count() == 0


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius):
    prints = [(d, brute_fingerprint(t)) for d, t in rows]
    root = list(range(len(prints)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(d, p, least.get(top(i))) for i, (d, p) in enumerate(prints)]


def near_copies(n, seed=7):
    rng, base = random.Random(seed), made(seed, 300).split()
    rows = []
    for i in range(n):
        words = list(base) if i % 3 else made(1000 + i, 120).split()
        for _ in range(i % 5):
            words[rng.randrange(len(words))] = "new"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("tree", [4096, 4])
def test_simhash_components(spark, tree):
    rows = near_copies(90) + [(200, None), (201, ""), (202, "a b"), (203, "A  b"), (None, "a b"), (0, "again the same id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    marks = simhash.marked(docs, 3)
    groups = simhash.near_duplicates(marks, tree=tree)
    got = [
        (r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in marks.join(groups, "fp").collect()
    ]
    assert sorted(got, key=repr) == sorted(brute_components(rows, 3), key=repr)


def test_bk_tree_finds_all_within_the_radius():
    rng = random.Random(3)
    values = [rng.getrandbits(64) for _ in range(50)]
    values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in values for _ in range(4)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert sorted(tree.within(v, 3)) == [i for i, x in enumerate(values) if (x ^ v).bit_count() <= 3]


def test_drop_near_duplicates_keeps_one_of_each(odd):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    # 1 twice, and null, empty and blank texts are one group, as are the two long texts.
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 2, 5, 7, 8, None]


def test_simhash_empty(empty):
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r["node"]: r["root"] for r in components.connected_components(
        spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100}


def test_leaks_reach_the_recall(spark):
    rng = random.Random(11)
    items = [(i, made(500 + i, 16 + 3 * (i % 12))) for i in range(40)] + [(90, None), (91, "..."), (92, "single7unique")]
    rows, planted = [], set()
    for k in range(200):
        item, text = items[k % 40]
        words = text.split()
        for _ in range(int(0.2 * len(words) + 1e-9) if k % 2 else 1):
            at, kind = rng.randrange(len(words)), rng.randrange(3)
            words[at:at + 1] = [["zz%d" % rng.randrange(10**6)], [words[at], "inserted"], []][kind]
        rows.append((k, made(9000 + k, 60) + " " + " ".join(words) + " " + made(7000 + k, 40)))
        planted.add((k, item))
    rows += [(1000 + k, made(20_000 + k, 150)) for k in range(100)] + [(5000, None), (5001, ""), (5002, "x single7unique y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    leaks = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    found = {(r["doc_id"], r["item_id"]) for r in leaks}
    assert len(found & planted) >= 0.95 * len(planted)
    assert not {d for d, _ in found} & set(range(1000, 1100))
    assert (5002, 92) in found
    texts = dict(rows)
    for r in leaks:
        span = decontaminate.words_of(texts[r["doc_id"]])[r["first_word"]:r["end_word"]]
        item = decontaminate.words_of(dict(items)[r["item_id"]])
        assert levenshtein(span, item) == r["edits"] <= 0.2 * len(item)


def with_edits(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        out[at:at + 1] = [["zz%d" % rng.randrange(10**6)], [out[at], "inserted"], []][kind]
    return out


@pytest.mark.parametrize("length", [16, 49, 100, 300, 600, 1200, 2000])
def test_recall_at_the_most_edits_of_every_length(length):
    rng, trials = random.Random(length), 150 if length < 500 else 20
    items = [(i, made(40_000 + i, length)) for i in range(20)]
    searcher = decontaminate.Searcher(items, 0.8, decontaminate.RECALL, decontaminate.SAMPLES)
    texts = []
    for k in range(trials):
        words = with_edits(items[k % 20][1].split(), int(0.2 * length + 1e-9), rng)
        texts.append(f"{made(k, 40)} {' '.join(words)} {made(k + 1000, 40)}")
    found = {(t, i) for t, i, *_ in searcher.search(texts)}
    assert sum((t, t % 20) in found for t in range(trials)) >= 0.96 * trials


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.95])
def test_leaks_equal_sliding_edit_distance(similarity):
    rng = random.Random(6)
    items = [(i, " ".join(rng.choice("abcdefghij") for _ in range(n))) for i, n in enumerate((1, 2, 4, 5, 5, 9, 14))]
    texts = []
    for _ in range(60):
        words = [rng.choice("abcdefghijklmnop") for _ in range(12)]
        item = rng.choice(items)[1].split()
        at = rng.randrange(12)
        words[at:at] = with_edits(item, rng.randrange(int((1 - similarity) * len(item) + 1e-9) + 1), rng)
        texts.append(" ".join(words))
    searcher = decontaminate.Searcher(items, similarity, 0.999, 3)
    found = {(t, i) for t, i, *_ in searcher.search(texts)}
    want = set()
    for t, text in enumerate(texts):
        words = text.split()
        for i, item in items:
            item = item.split()
            most = int((1 - similarity) * len(item) + 1e-9)
            spans = ((a, b) for a in range(len(words)) for b in range(a, min(len(words), a + len(item) + most) + 1))
            if any(abs(b - a - len(item)) <= most and levenshtein(words[a:b], item) <= most for a, b in spans):
                want.add((t, i))
    assert found <= want and len(found) >= 0.98 * len(want)


def test_leaks_side_by_side():
    item = made(77, 30)
    words = item.split()
    short = " ".join(words[:10] + words[11:])
    searcher = decontaminate.Searcher([(1, item)], 0.8, 0.98, 3)
    for text, edits in ((f"{short} {item}", [1, 0]), (f"{item} {short}", [0, 1]), (f"{item} {item} {short}", [0, 0, 1])):
        found = sorted((a, b, e) for _, _, e, a, b in searcher.search([f"head {text} tail"]))
        assert [e for *_, e in found] == edits and all(x[1] <= y[0] for x, y in zip(found, found[1:], strict=False))


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_item_blocks_change_nothing(spark):
    items = spark.createDataFrame([(i, made(i, 20)) for i in range(9)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, made(i, 20) + " end") for i in range(12)], "doc_id bigint, text string")
    rows = [sorted(map(tuple, decontaminate.find_leaks(docs, items, block=b).collect())) for b in (2, 100)]
    assert rows[0] == rows[1] and len(rows[0]) == 9
    assert sorted(r[0] for r in decontaminate.drop_leaked(docs, items, block=2).collect()) == [9, 10, 11]


def test_decontamination_odd_rows(spark, odd, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    item = spark.createDataFrame([(1, "one two three four"), (None, "Two three")], "item_id bigint, text string")
    assert decontaminate.find_leaks(odd, none).count() == 0 and decontaminate.drop_leaked(odd, none).count() == 10
    assert decontaminate.find_leaks(empty, item).count() == 0
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(odd, item).collect()} == {(1, 1), (1, None)}
    kept = decontaminate.drop_leaked(odd, item)
    assert kept.columns == odd.columns and kept.count() == 8


def test_forward_sums_all_segmentations():
    table = {"a": (0.2, 0.1), "b": (0.1, 0.3), "ab": (0.05, 0.02), "aba": (0.01, 0.2)}
    model = langid.PieceModel(["x", "y"], table)

    def brute(word, k):
        if not word:
            return 1.0
        return sum(table[word[:n]][k] * brute(word[n:], k) for n in range(1, len(word) + 1) if word[:n] in table)

    for word in ("a", "ab", "abab", "abaabba"):
        assert np.allclose(np.exp(model.forward(word)), [brute(word, 0), brute(word, 1)])
    assert all(np.isfinite(model.forward("abz" * 20_000)))
    # Far below a double's range: the log-probability of a word and its double, between letters no piece joins.
    long, twice = (np.array(model.forward("z".join(["abaabba" * 40] * n))) for n in (30, 60))
    assert np.allclose(twice, 2 * long + np.log(langid._FLOOR), rtol=1e-9) and long.max() < -3000


def test_forward_over_long_pieces_of_the_vocabulary():
    pieces = langid.letter_pieces(tokenizer_path(langid.VOCABULARY))
    assert max(map(len, pieces)) == 16
    rng = random.Random(1)
    table = {p: (rng.random(), rng.random(), rng.random()) for p in pieces}
    model = langid.PieceModel(["x", "y", "z"], table)

    def brute(word, k):
        sums = [1.0]
        for end in range(1, len(word) + 1):
            sums.append(sum(sums[s] * table[word[s:end]][k] for s in range(end) if word[s:end] in table)
                        + (word[end - 1] not in table) * sums[end - 1] * langid._FLOOR)
        return sums[-1]

    for piece in [p for p in pieces if len(p) >= 9][::40]:
        for word in (piece, piece + "s", "un" + piece, piece + "Ω" + piece):
            assert np.allclose(np.exp(model.forward(word)), [brute(word, k) for k in range(3)])


def test_expected_uses_equal_enumeration():
    table = {"a": (0.2, 0.1), "b": (0.1, 0.3), "ab": (0.05, 0.02), "aba": (0.01, 0.2)}
    model = langid.PieceModel(["x", "y"], table)

    def cuts(word):
        if not word:
            yield ()
        for n in range(1, len(word) + 1):
            if word[:n] in table:
                yield from ((word[:n], *rest) for rest in cuts(word[n:]))

    for word in ("ab", "abaabba"):
        want = defaultdict(float)
        every = [(c, np.prod([table[p][1] for p in c])) for c in cuts(word)]
        for c, p in every:
            for piece in c:
                want[piece] += 3 * p / sum(q for _, q in every)
        got = Counter()
        model.expected(word, 1, 3, got)
        assert got.keys() == want.keys() and all(np.isclose(got[k], want[k]) for k in got)
    far = Counter()
    model.expected("aba" * 3000, 0, 1, far)
    assert np.isclose(sum(n * len(piece) for piece, n in far.items()), 9000)


def test_language_of_held_out_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    judged = langid.op6_langid(spark, folder).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(judged) == docs.count()
    held = [r for r in judged if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in judged)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)


def test_language_odd_rows(spark, odd, empty):
    model = langid.fit(odd, tokenizer_path(langid.VOCABULARY))
    got = {(r["doc_id"], r["lang_pred"] == "und", r["score"] == 0) for r in langid.predict(odd, model).collect()}
    assert {(2, True, True), (3, True, True), (4, True, True), (7, True, True), (5, False, False)} <= got
    assert langid.predict(empty, model).count() == 0
    nothing = langid.fit(empty, tokenizer_path(langid.VOCABULARY))
    assert {r["lang_pred"] for r in langid.predict(odd, nothing).collect()} == {"und"}
    kept = langid.keep_identified(odd)
    assert kept.columns == odd.columns and not {2, 3, 4, 7} & {r["doc_id"] for r in kept.collect()}


VALUES = (
    ("card", "4539 1488 0343 6467"), ("card", "4111111111111111"), ("iban", "GB82 WEST 1234 5698 7654 32"),
    ("phone", "+1 (734) 555-6564"), ("ssn", "536-90-4399"), ("ip", "73.231.25.216"), ("date", "1987-02-28"),
    ("date", "31.12.1999"), ("email", "jane.Doe7@mail5.example.com"), ("secret", "24be64439e3e49cf46b2d7c9"),
)


@pytest.mark.parametrize(("kind", "value"), VALUES)
def test_pseudonyms_keep_the_form_and_can_be_restored(kind, value):
    new = pii.Pseudonyms("k").of(kind, value)
    assert new != value and pii.Pseudonyms("k", forward=False).of(kind, new) == value
    assert pii.Pseudonyms("other").of(kind, value) != new
    if kind not in ("ip",):
        assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", new))) == re.sub(
            "[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", value)))
    assert pii.Pseudonyms("k").of(kind, new) is not None


def test_feistel_is_a_permutation():
    feistel = pii.Feistel("key")
    for size in (1, 2, 10, 97, 1000):
        image = [feistel.permute(i, size, "t") for i in range(size)]
        assert sorted(image) == list(range(size))
        assert [feistel.restore(x, size, "t") for x in image] == list(range(size))


def test_pseudonymise_rows(spark, odd, empty):
    text = ("Mail jane@x.org or +1 (734) 555-6564, card 4111111111111111, not 4111111111111112; ip 10.0.0.1 not "
            "999.1.1.1, born 1990-13-45 or 1990-12-05. password=fb014dfa643a529248 end")
    docs = spark.createDataFrame([(1, text), (2, "again jane@x.org"), (3, None), (4, "")], "doc_id int, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(docs, "k", count="n").collect()}
    assert [got[i]["n"] for i in (1, 2, 3, 4)] == [6, 1, 0, 0]
    for value in ("jane@x.org", "555-6564", "4111111111111111", "10.0.0.1", "1990-12-05", "fb014dfa643a529248"):
        assert value not in got[1]["text"]
    for value in ("4111111111111112", "999.1.1.1", "1990-13-45", "password="):
        assert value in got[1]["text"]
    assert got[2]["text"].split()[1] in got[1]["text"] and got[3]["text"] is None and got[4]["text"] == ""
    found = pii.find_personal_data(docs, "k").where("doc_id = 1").collect()
    assert all(text[r["start"]:r["end"]] not in got[1]["text"] for r in found) and len(found) == 6
    same = pii.pseudonymise(odd, "k")
    assert same.columns == odd.columns and same.count() == 10 and pii.pseudonymise(empty, "k").count() == 0


def test_values_before_digit_groups_and_capital_words():
    rng = random.Random(8)
    pseudonyms = pii.Pseudonyms("k")
    tails = ["", " 123", " 2024", " PAID", " 12", "-77", " USD 100", ", 5", " 4111"]
    forms = [(k, v) for k, v in VALUES if k != "secret"] + [
        ("card", "4111 1111 1111 1111"), ("card", "3782 822463 10005"), ("iban", "ES91 2100 0418 4502 0005 1332"),
        ("iban", "ES9121000418450200051332"), ("iban", "NO93 8601 1117 947"), ("phone", "+44 20 7946 0958"),
    ]
    for kind, value in forms:
        for tail in tails:
            if tail == "-77" and kind in ("ssn", "date"):  # another form of number
                continue
            for head in ("", "Pay ", "No 7: ", "call 55 " if kind == "card" else "to "):
                text = f"{head}{value}{tail} {rng.choice(['end', '', 'A1'])}"
                out = pii.replaced(text, pii.find_values(text, pseudonyms))
                assert value not in out, text


def test_cards_against_a_plain_matcher():
    rng = random.Random(3)
    pseudonyms = pii.Pseudonyms("k")
    for _ in range(1500):
        groups = ["".join(rng.choice("0123456789") for _ in range(rng.choice((4, 4, 4, 4, 3, 6, 5)))) for _ in range(9)]
        text = " ".join(groups)
        left = [text[a:b] for a, b, *_ in pii.find_values(text, pseudonyms)]
        taken = " ".join(left).split()
        for i in range(len(groups)):
            for form in pii.CARD_GROUPS:
                some = groups[i : i + len(form)]
                if tuple(map(len, some)) == form and not pii.luhn("".join(some)):
                    assert set(some) & set(taken), (text, some)


@pytest.mark.parametrize("sign", "-/.")
def test_dates_of_all_years_are_permuted_in_their_form(sign):
    forward, back = pii.Pseudonyms("k"), pii.Pseudonyms("k", forward=False)
    days = [pii.FIRST_DAY + timedelta(days=i) for i in range(0, pii.DAYS, 7)]
    written = set()
    for d in days:
        for month in {f"{d.month:02d}", str(d.month)}:
            for day in {f"{d.day:02d}", str(d.day)}:
                written |= {sign.join(x) for x in ((str(d.year), month, day), (day, month, str(d.year)), (month, day, str(d.year)))}
    images = {v: forward._date(v) for v in written}
    images = {v: n for v, n in images.items() if n is not None}
    assert len(set(images.values())) == len(images) > len(days) * 3
    for v, n in images.items():
        assert back._date(n) == v and [len(x) for x in v.split(sign)] == [len(x) for x in n.split(sign)]
    assert forward._date("2001-03-05").split("-") == forward._date("05.03.2001").split(".")[::-1]


def test_many_values_take_linear_time():
    pseudonyms = pii.Pseudonyms("k")
    took = []
    for n in (4_000, 16_000):
        text = " ".join(f"user{i}@mail.example.com 10.0.{i % 250}.{i % 199} 1 2 3 4 5 6 7 8" for i in range(n))
        start = time.process_time()
        assert len(pii.find_values(text, pseudonyms)) >= 2 * n
        took.append(time.process_time() - start)
    assert took[1] < 9 * took[0]


def test_the_key_is_a_setting_or_drawn(spark):
    drawn = pii.session_key(spark)
    assert len(drawn) == 64 and pii.session_key(spark) == drawn
    spark.conf.set(pii.KEY_SETTING, "mine")
    assert pii.session_key(spark) == "mine"
    spark.conf.unset(pii.KEY_SETTING)


def test_license_spans(spark, odd, empty):
    templates = spark.createDataFrame(list(licenses.NOTICES), "template string, text string")
    gpl = dict(licenses.NOTICES)["gpl-3.0-header"]
    changed = gpl.split()
    changed[4:5] = ["may", "well"]
    del changed[20]
    rows = [
        (1, "Some words.\nReleased under the MIT License. And more."), (2, made(4, 100)),
        (3, made(5, 50) + " " + " ".join(changed) + " " + made(6, 50)),
        (4, "MIT License is named here"), (5, "Licensed under CC BY-NC 4.0. " * 2), (6, None), (7, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = licenses.scan_licenses(docs, templates).collect()
    assert {(r["doc_id"], r["template"]) for r in got} >= {(1, "mit"), (3, "gpl-3.0-header"), (5, "cc-by-nc-4.0")}
    assert {r["doc_id"] for r in got} == {1, 3, 5}
    one = next(r for r in got if r["doc_id"] == 1)
    assert rows[0][1][one["first_char"]:one["end_char"]] == "Released under the MIT License" and one["coverage"] == 1
    assert sum(r["doc_id"] == 5 and r["template"] == "cc-by-nc-4.0" for r in got) == 2
    words = licenses.words_of(gpl)
    assert next(r for r in got if r["doc_id"] == 3)["matched_words"] >= len(words) - 2
    assert licenses.scan_licenses(odd, templates).count() == 0 and licenses.scan_licenses(empty, templates).count() == 0
    assert licenses.scan_licenses(docs, templates.where("false")).count() == 0


def test_license_spans_where_lower_case_is_longer():
    index = licenses.LicenseIndex(list(licenses.NOTICES))
    for before in ("İa İa İa ", "İ", "ΑΣ ẞ ", "", "x" * 70_000 + " İ "):
        text = before + "Released under the MIT License. More"
        found = [m for m in index.scan(text, 0.8) if index.names[m[0]] == "mit"]
        assert [text[m[-2]:m[-1]] for m in found] == ["Released under the MIT License"]


def unbanded(template, words):
    """Most (score, matched words) of any local alignment: match 2, mismatch and gap -1."""
    before = [(0, 0)] * (len(words) + 1)
    best = (0, 0)
    for own in template:
        row = [(0, 0)]
        for j, word in enumerate(words):
            same = own == word
            cell = max((before[j][0] + (2 if same else -1), before[j][1] + same),
                       (before[j + 1][0] - 1, before[j + 1][1]), (row[j][0] - 1, row[j][1]))
            row.append(cell if cell[0] > 0 else (0, 0))
        best = max(best, *row)
        before = row
    return best


def test_band_over_everything_is_the_unbanded_alignment():
    rng = np.random.default_rng(11)
    for _ in range(150):
        template, words = rng.integers(1, 6, rng.integers(1, 14)), rng.integers(0, 6, rng.integers(1, 24))
        matched, first, end = licenses.align(template, words, -len(template), len(words))
        assert matched == unbanded(template.tolist(), words.tolist())[1]
        assert matched <= end - first <= len(words)


def test_licenses_against_unbanded_alignment_of_all_templates():
    """Texts with up to one word in twelve changed, dropped or put in: the scan reports the templates that reach the
    coverage without a band, and no others."""
    templates = [*licenses.NOTICES, *licenses.TEXTS]
    index = licenses.LicenseIndex(templates)
    rng = random.Random(3)
    for name, text in templates:
        words = licenses.words_of(text)
        for at in reversed(range(rng.randrange(3, 12), len(words) - 3, 12)):
            words[at:at + 1] = rng.choice([[], ["other"], [words[at], "more"]])
        document = made(rng.randrange(99), 30).split() + words + made(rng.randrange(99), 30).split()
        got = {index.names[m[0]]: m[1] for m in sorted(index.scan(" ".join(document), 0.8), key=lambda m: m[1])}
        want = {}
        for other, own in templates:
            own = licenses.words_of(own)
            # The alignment of another license's text is left out where too few of its words are there.
            if sum((Counter(own) & Counter(document)).values()) >= 0.8 * len(own):
                matched = unbanded(own, document)[1]
                if matched >= 0.8 * len(own):
                    want[other] = matched
        assert name in want and got == want, name


def test_licenses_in_a_very_long_text():
    index = licenses.LicenseIndex([*licenses.NOTICES, *licenses.TEXTS])
    mit = dict(licenses.TEXTS)["mit-text"]
    text = " ".join([made(1, 150_000), mit, made(2, 150_000), mit, "Permission is hereby granted, free of charge. " * 500])
    start = time.perf_counter()
    found = [m for m in index.scan(text, 0.8) if index.names[m[0]] == "mit-text"]
    assert [m[2] for m in found] == [1.0, 1.0] and time.perf_counter() - start < 20
    for m in found:
        assert licenses.words_of(text[m[-2]:m[-1]]) == licenses.words_of(mit)


def test_winnowing_keeps_a_gram_of_every_window():
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 1000, 400).astype(np.uint64)
    kept = set(licenses.winnowed(hashes, 4))
    assert all(kept & set(range(i, i + 4)) for i in range(397))
