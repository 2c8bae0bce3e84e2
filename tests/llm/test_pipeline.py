"""The whole pipeline against brute force, on documents with odd and planted rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_text_operators import brute_components
from tokenizers import Tokenizer

import corpus_pipeline
from basketry.llm import decontaminate, langid, packing
from basketry.llm.tokens import tokenizer_path

PRIVATE = "Write to jane.roe@mail.example.org or pay with 4111 1111 1111 1111 before noon, said the note on the door."
# Extra columns with the names that stages make for themselves.
EXTRA = ("row", "row_", "fp", "fp_", "lang_pred", "score_", "number", "place", "n", "ids")


def edits_within(item, words):
    """Fewest word edits between the item and any stretch of the words."""
    words = np.array(words)
    row = np.zeros(len(words) + 1, np.int64)
    steps = np.arange(len(words) + 1)
    for i, own in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (words != own), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def leaked(text, items):
    words = decontaminate.words_of(text)
    bag = Counter(words)
    for item in items:
        most = int((1 - decontaminate.SIMILARITY) * len(item) + 1e-9)
        if item and sum((Counter(item) & bag).values()) >= len(item) - most and edits_within(item, words) <= most:
            return True
    return False


@pytest.fixture(scope="module")
def planted(spark, folder, tmp_path_factory):
    """(folder, private doc_ids): the documents and benchmark with planted and odd rows."""
    home, rng = tmp_path_factory.mktemp("planted"), random.Random(8)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    some = [r["text"] for r in docs.where("length(text) > 400").orderBy("doc_id").limit(12).collect()]
    item = max((r["text"] for r in bench.collect()), key=lambda t: len((t or "").split()))
    near = some[1].split(" ")
    near[len(near) // 2] = "changed"
    changed = item.split(" ")
    changed[len(changed) // 2] = "changed"
    long = " ".join(rng.choice(some[2].split()) for _ in range(60_000))
    # Words of two documents in another order, as these themselves may be copies or hold an item.
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in some[7:9]]
    texts = [None, "", " \n\t", "123 456 !!!", some[0], some[0], " ".join(near), f"{some[3]} {item} {some[4]}",
             f"{some[5]} {' '.join(changed)} {some[6]}", f"{mixed[0]} {PRIVATE}", f"{mixed[1]} {PRIVATE}", long]
    rows = [(10_000_000 + i, t) for i, t in enumerate(texts)] + [(None, some[9] + " and no id"), (10_000_004, some[0])]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    both = docs.unionByName(more, allowMissingColumns=True).withColumns({c: F.lit(1) for c in EXTRA})
    both.repartition(3).write.parquet(f"{home}/documents.parquet")
    odd = spark.createDataFrame([(None, None), (None, "")], bench.select("item_id", "text").schema)
    bench.unionByName(odd, allowMissingColumns=True).write.parquet(f"{home}/benchmark.parquet")
    return str(home), {10_000_009, 10_000_010}


def test_every_stage_equals_brute_force(spark, planted, tmp_path):
    folder, private = planted
    items = [decontaminate.words_of(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids, kept = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        rows = after.collect()
        if name != "packing":
            assert after.columns == columns
        texts = Counter((r["doc_id"], r["text"]) for r in rows) if name != "packing" else None
        if name == "language_id":
            model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), tokenizer_path(langid.VOCABULARY))
            judged = langid.predict(docs, model, "judged", "likely").collect()
            want = Counter((r["doc_id"], r["text"]) for r in judged if r["judged"] != "und" and r["likely"] >= 0.5)
            assert texts == want
            ids = {d for d, _ in texts}
            assert not ids & set(range(10_000_000, 10_000_004)) and ids >= set(range(10_000_004, 10_000_012))
        elif name == "near_duplicates":
            groups = {c for _, _, c in brute_components([(r["doc_id"], r["text"]) for r in before], 3)}
            assert Counter(d for d, _ in texts.elements()) == Counter(groups)
            assert not {10_000_004, 10_000_005, 10_000_006} & {d for d, _ in texts}
        elif name == "decontamination":
            want = Counter((r["doc_id"], r["text"]) for r in before if not leaked(r["text"], items))
            assert texts == want and not {10_000_007, 10_000_008} & {d for d, _ in texts}
        elif name == "pseudonyms":
            kept = {r["doc_id"]: r["text"] for r in rows}
            was = {r["doc_id"]: r["text"] for r in before}
            assert len(rows) == len(before) and kept.keys() == was.keys()
            ends = {kept[d][-len(PRIVATE):] for d in private & kept.keys()}
            assert len(ends) == 1 and private <= kept.keys()
            assert not any(v in text for text in ends for v in ("jane.roe", "4111 1111"))
            assert all(kept[d] == t or any(c.isdigit() or c == "@" for c in t) for d, t in was.items())
        else:
            plain = Tokenizer.from_file(tokenizer_path(packing.TOKENIZER))
            pieces = defaultdict(list)
            for r in rows:
                pieces[r["doc_id"]].append((r["start"], bytes(r["ids"])))
            assert pieces.keys() == kept.keys()
            for d, text in kept.items():
                whole = [*plain.encode(text, add_special_tokens=False).ids, 2]
                assert b"".join(p for _, p in sorted(pieces[d])) == np.array(whole, "<u4").tobytes()
        docs = after


def test_pipeline_of_empty_tables(spark, planted, tmp_path):
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{planted[0]}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
