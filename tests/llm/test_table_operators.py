"""Quality rules, URL filter, rollups, chats and the pipeline against brute force and odd rows."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import corpus_pipeline
from basketry.functions.lineage import fresh_path
from basketry.llm import chats, quality, rollups, urls
from basketry.llm.common import free_name
from basketry.llm.tokens import tokenizer_path


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    covered = {j for i, g in enumerate(grams) if times[g] > 1 for j in (i, i + 1, i + 2)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


TEXTS = [
    None, "", " \n\t", "a", "a b c", "a b c a b c", "a a a a", "x y z\nx y z\n\n \nx y z", "é ü 🙂 #*$%&|<>\n#", "a\u00a0b c\x1cd",
    " ".join(f"w{i}" for i in range(60)), "\n".join(["one two three four five six"] * 12),
    " ".join(random.Random(1).choice("abcd") for _ in range(3000)), "x\r\ny\x0bz\x0cw",
]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_counts(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, hash string")
    got = {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in quality.judge(docs, [0] * 16).collect()}
    assert got == {i: base(t) for i, t in enumerate(TEXTS)}


def test_quality_beside_clashing_names(spark):
    names = ["n_words", "Hashes", "_w", "_g", "llr", "base_failed", "KEPT", "n_symbols", "_own_llr"]
    plain = spark.createDataFrame([(1, "one two # three"), (2, None)], "doc_id int, text string")
    docs = plain.select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    judged, want = quality.judge(docs, [0] * 16, least_words=1), quality.judge(plain, [0] * 16, least_words=1)
    assert judged.columns[: len(docs.columns)] == docs.columns
    lowered = [c.lower() for c in judged.columns]
    assert len(set(lowered)) == len(lowered) and len(judged.columns) == len(docs.columns) + len(want.columns) - 2
    got = sorted(tuple(r) for r in judged.collect())
    assert [r[2 + len(names):] for r in got] == [tuple(r)[2:] for r in sorted(want.collect())]
    assert all(r[2 : 2 + len(names)] == tuple(f"own {n}" for n in names) for r in got)
    counted = quality.base_counts(docs)
    assert "hashes_" in counted.columns and "n_words_" in counted.columns


def test_quality_tells_target_from_junk(spark):
    rng = random.Random(2)
    good = [" ".join(f"g{rng.randrange(15)}" for _ in range(80)) for _ in range(60)]
    junk = [" ".join(f"j{rng.randrange(15)}" for _ in range(80)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(good + junk)) + [(500, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(30)] + [(i, 0, None) for i in range(60, 90)] + [(None, 1, 0), (3, 1, 0)],
        "doc_id bigint, quality int, toxic int")
    ratios = quality.log_ratios(docs, labels)
    kept = {r["doc_id"] for r in quality.judge(docs, ratios).where("kept").collect()}
    assert kept == set(range(60))
    assert quality.judge(docs.repartition(7), ratios).where("kept").count() == 60
    assert set(quality.log_ratios(docs, labels.where("false"))) == {0}
    assert quality.judge(docs.where("false"), ratios).count() == 0


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


URLS = [
    None, "", "no scheme", "http://A.EXAMPLE.net/en/1?x=/de/", "https://example.net", "https://example.net/en", "http://x.net#/en/",
    "https://www.example.com/de/1", "https://notexample.com/de/1", "ftp://Kiwi.org/fr/a#b", "http://org/fr/", "://", "http://?q",
    "a://b://c/d", "https://net/", "https://planet/", "https://ÄB.example.org/fr/\nx?y", "https://www.casino-win.example.org/en/1",
]


def brute_rule(host, path):
    best = None
    for rule, verdict in urls.RULES:
        own, _, prefix = rule.partition("/")
        fits = (host == own or host.endswith("." + own)) and path.startswith("/" + prefix)
        if fits and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best or (None, None)


def test_url_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS)], "page_id bigint, url string, host string")
    model = urls.fit_urls(urls.labelled_urls(spark))
    for r in urls.judge_urls(pages, urls.RULES, model).collect():
        host, path = parts(URLS[r["page_id"]])
        rule, verdict = brute_rule(host, path)
        assert (r["host_"], r["path"], r["rule"], r["host"]) == (host, path, rule, "own"), URLS[r["page_id"]]
        assert r["verdict"] == (verdict or ("block" if r["p_block"] >= 0.5 else "allow"))
    assert urls.judge_urls(pages.where("false"), urls.RULES, model).count() == 0


def test_url_model_learns_hosts(spark):
    model = urls.fit_urls(urls.labelled_urls(spark))
    seen = ["https://m.casino-club.example.com/en/7", "http://cheap-pills-now.example.org/x", "https://city-library.example.com/en/7",
            "https://www.weather-station.example.org/fr/1"]
    pages = spark.createDataFrame(list(enumerate(seen)), "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(pages, (), model).collect()}
    assert got == {0: "block", 1: "block", 2: "allow", 3: "allow"}
    one_label = urls.labelled_urls(spark).where("label = 1")
    assert urls.fit_urls(one_label) is None
    assert {r["verdict"] for r in urls.judge_urls(pages, (), None).collect()} == {"allow"}


CHANGES = ("op string, source string, lang string, tokenizer string, n_tokens bigint, old_source string, old_lang string, "
           "old_tokenizer string, old_tokens bigint")


def test_rollups_by_deltas(spark):
    rollup = rollups.Rollup(spark, fresh_path(spark, "test-rollup"))
    assert rollup.totals().count() == 0
    rng, live, log = random.Random(4), {}, []
    for b in range(5):
        rows = []
        for d in range(30):
            new = (rng.choice(["s", "t", None]), rng.choice(["en", None]), "v1", rng.choice([3, 5, None]))
            if d not in live:
                live[d] = new
                rows.append(("insert", *new, None, None, None, None))
            elif rng.random() < 0.3:
                rows.append(("delete", *live.pop(d), None, None, None, None))
            elif rng.random() < 0.5:
                rows.append(("revise", *new, *live[d]))
                live[d] = new
        log.append(spark.createDataFrame(rows, CHANGES))
        assert rollup.commit(f"b{b}", log[-1])
        assert not rollup.commit(f"b{b}", log[0])  # delivered again, even with other rows
    want = defaultdict(lambda: [0, 0])
    for source, lang, version, n in live.values():
        want[source, lang, version][0] += 1
        want[source, lang, version][1] += n or 0
    def shown(r):
        return {(x["source"], x["lang"], x["tokenizer"]): [x["n_docs"], x["n_tokens"]] for x in r.totals().collect()}
    assert shown(rollup) == dict(want)
    small = rollup.compact(fresh_path(spark, "compacted"))
    assert shown(small) == dict(want)
    again = small.compact(fresh_path(spark, "compacted"))
    for b, changes in enumerate(log):
        assert not small.commit(f"b{b}", changes) and not again.commit(f"b{b}", changes)
    assert shown(small) == shown(again) == dict(want)
    more = log[0].where("op = 'insert'").limit(1).withColumn("times", F.lit(3))
    assert again.commit("more", more) and sum(n for n, _ in shown(again).values()) == sum(n for n, _ in want.values()) + 3
    with pytest.raises(ValueError, match="holds a rollup"):
        rollup.compact(small.path)
    assert rollup.commit("empty", log[0].where("false")) and shown(rollup) == dict(want)
    with pytest.raises(Exception, match="unknown change"):
        rollup.commit("bad", log[0].limit(1).selectExpr("'move' as op", *log[0].columns[1:]))
    assert not rollup.committed("bad")
    with pytest.raises(ValueError, match="batch id"):
        rollup.commit("../x", log[0])
    # A batch without _SUCCESS was interrupted: it counts nowhere and is written anew.
    place = Path(rollup._place("b2").removeprefix("file:"))
    (place / "_SUCCESS").unlink()
    assert shown(rollup) != dict(want) and rollup.commit("b2", log[2]) and shown(rollup) == dict(want)


def test_rollup_in_an_empty_folder(spark, tmp_path):
    assert rollups.Rollup(spark, str(tmp_path)).totals().count() == 0
    assert not rollups.Rollup(spark, str(tmp_path / "none")).committed("x")
    small = rollups.Rollup(spark, str(tmp_path)).compact(str(tmp_path / "small"))
    assert small.totals().count() == 0 and small.totals().columns == ["source", "lang", "tokenizer", "n_docs", "n_tokens"]


def test_rollup_query_counts_tokens(spark, folder):
    got = rollups.op7_rollups(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    first = {}
    for r in sorted(docs, key=lambda r: r["doc_id"]):
        first.setdefault(r["text"] or "", r)
    model = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    want = defaultdict(lambda: [0, 0])
    for r in first.values():
        want[r["source"], r["lang"]][0] += 1
        want[r["source"], r["lang"]][1] += len(model.encode(r["text"] or ""))
    assert {(r["source"], r["lang"]): [r["n_docs"], r["n_tokens"]] for r in got} == dict(want)
    assert {r["tokenizer"] for r in got} == {"piece_bpe_32k"}


def test_token_counts_are_the_tokenizers(spark):
    texts = ["", None, "one two", "Ünïcode 北京 🙂", " a  b \n c ", "x" * 30_000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, first int")
    files = {"a": tokenizer_path("word_bpe_49k.json"), "b": tokenizer_path("piece_bpe_32k.model")}
    plain, model = Tokenizer.from_file(files["a"]), SentencePieceProcessor(model_file=files["b"])
    for r in rollups.with_token_counts(docs, files).collect():
        text = r["text"] or ""
        assert (r["a"], r["b"]) == (len(plain.encode(text, add_special_tokens=False).ids), len(model.encode(text)))


def test_copies_by_source(spark):
    rows = [(3, "x", "s", "en", 5, 6), (1, "x", None, "en", 5, 6), (1, "x", None, "en", 5, 6), (None, "x", "s", "en", 5, 6),
            (None, "y", "s", None, 1, 2), (None, "y", "t", None, 1, 2), (9, "z", "s", "en", 0, 0)]
    counted = spark.createDataFrame(rows, "doc_id int, digest string, source string, lang string, first int, second int")
    got = {tuple(r) for r in rollups.copies_by_source(counted).collect()}
    assert got == {("s", "en", 5, 6, 2, 2), (None, "en", 5, 6, 2, 1), ("s", None, 1, 2, 1, 0), ("t", None, 1, 2, 1, 1),
                   ("s", "en", 0, 0, 1, 0)}


def brute_chats(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or "", role, text))
    turns = {c: [x[6:] for x in sorted(t, key=lambda x: x[:6])] for c, t in by.items()}
    kept = [
        c for c, t in turns.items()
        if not any(len(u) > len(t) and u[:len(t)] == t or u == t and d < c for d, u in turns.items() if d != c)
    ]
    return {c: "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns[c]) for c in kept}


@pytest.mark.parametrize("parts", [None, 23])
def test_chats_collapse(spark, parts):
    rng, rows = random.Random(9), []
    for c in range(80):
        n = rng.randrange(1, 7)
        seed = rng.randrange(6)
        rows += [(c, 3 * k, rng.choice(["user", "user", None]) if k == 4 else "user", f"t{seed}-{k}" if k < 5 else None) for k in range(n)]
    rows += [(200, None, None, None), (200, 0, "user", ""), (201, 0, "user", ""), (202, 0, "user", None), (203, 1, "a", "x"),
             (203, 1, "a", "x"), (204, 1, "a", "x"), (None, 0, "user", "t1-0"), (205, 2 * 10**9, "a", "x")]
    rows += [(206, None, "a", "same")] * 90 + [(207, None, "a", "same")] * 91 + [(208, 7, "b", "same")] * 60
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("part", chats.F.lit("x"))
    got = chats.format_chats(turns, parts).collect()
    assert {r["conv_id"]: r["text"] for r in got} == brute_chats(rows)
    joined = defaultdict(str)
    for r in sorted(chats.format_chats(turns, parts, part=2).collect(), key=lambda r: r["part"]):
        joined[r["conv_id"]] += r["text"]
    assert dict(joined) == brute_chats(rows)
    blocks = chats.sorted_turns(turns, 23).groupBy("conv_id", "block").count().where("conv_id > 205").collect()
    assert max(r["count"] for r in blocks) < 60 and sum(r["count"] for r in blocks) == 241
    assert chats.format_chats(turns.where("false")).count() == 0


def test_free_name(spark):
    assert free_name(spark.createDataFrame([(1, 2)], "A int, a_ int"), "a") == "a__"


def test_pipeline_stages_take_effect(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
            after = docs.count()
            assert after < before if name == "near_duplicates" else after <= before
            before = after
    assert docs.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, folder).count() == docs.count()
