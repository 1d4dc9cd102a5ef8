"""Tokens, packing, order, archives, models and decontamination on small fixtures."""

from __future__ import annotations

import hashlib
import random
import uuid
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from bodega.llm import decontaminate, language, packing, tokens, toxicity, training_order, warc
from bodega.llm.arrays import slices

DDL = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts(number=400):
    pick = random.Random(1)
    letters = [*"ab't sr evlmd  \n\t\r12é漢,.!-  '", "<|endoftext|>", "<|endof", "text|>"]
    return ["".join(pick.choices(letters, k=pick.randint(0, 80))) for _ in range(number)] + [None, "", "'s", "it's", "a\n's", "x  'll"]


def test_ids_are_those_of_the_library(library):
    batch = pa.record_batch({"text": pa.array(odd_texts(4000))})
    for rows, data, bounds in slices([batch], "text", 10_000):
        ids, at = tokens.encoder().encode(data, bounds)
        for k, text in enumerate(rows.column(0).to_pylist()):
            assert ids[at[k] : at[k + 1]].tolist() == library(text)
    data = np.frombuffer(b"x <|endoftext|> y<|endof" + b"text|>", np.uint8)
    ids, at = tokens.encoder().encode(data, np.array([0, 24, len(data)]))
    assert ids[: at[1]].tolist()[:4] == [87, 220, 50256, 331] and 50256 not in ids[4:], "names do not cross texts"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], f"{DDL}, length int")


def test_packing_loses_nothing_and_fills_sequences(spark, library):
    texts = [*odd_texts(), "word " * 3000]
    found = packing.pack(documents(spark, texts), 64).collect()
    held: dict = {}
    for r in found:
        ids = [*library(texts[r["doc_id"]]), 0]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4"))
        assert r["length"] == 64 or r["piece"] == 0
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in found) == sum(len(library(t)) + 1 for t in texts)
    for parts in held.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 64
    assert len(held) <= -(-sum(r["length"] for r in found) // 64) + 2


def test_the_permutation_is_one():
    for size in (1, 2, 5, 1000, 65_537):
        assert sorted(training_order.permuted(np.arange(size), size, 3).tolist()) == list(range(size))


def test_shards_hold_every_sequence_in_order(spark, library, tmp_path):
    texts = [*odd_texts(60), "word " * 500]
    manifest = training_order.write(documents(spark, texts), str(tmp_path / uuid.uuid4().hex), length=16)
    back = training_order.read(manifest, length=16).orderBy("slot").collect()
    assert [r["slot"] for r in back] == list(range(len(back)))
    want = {(i, p): np.array(([*library(t), 0])[p * 16 : p * 16 + 16], "<u2").tobytes()
            for i, t in enumerate(texts) for p in range(-(-(len(library(t)) + 1) // 16))}
    assert {(r["doc_id"], r["piece"]): bytes(r["ids"]) for r in back} == want
    later = training_order.read(manifest, length=16, from_slot=40).orderBy("slot").collect()
    assert [r["slot"] for r in later] == list(range(40, len(back)))


def test_archives_read_back_and_answer_lookups(spark, tmp_path):
    html = ["x" * 150, "x" * 150, "short", "short", None, "é" * 80]
    rows = [(i, f"http://www.h{i % 2}.org/P{i}?q", text, "k") for i, text in enumerate(html)]
    rows += [(None, None, "x" * 150, "k")]
    parts = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string, key string"), str(tmp_path / "w"))
    found = {r["page_id"]: r for r in warc.read(parts).collect()}
    for i, _, text, _ in rows:
        assert found[i]["payload_digest"] == hashlib.sha256((text or "").encode()).hexdigest()
        assert found[i]["payload_bytes"] == len((text or "").encode())
    assert {i: r["refers_to"] for i, r in found.items()} == {0: None, 1: 0, 2: None, 3: None, 4: None, 5: None, None: 0}
    asked = spark.createDataFrame([("http://h1.org/p3?q",), ("http://nowhere.org/",)], "url string")
    assert [(r["page_id"], r["html"]) for r in warc.lookup(parts, asked).collect()] == [(3, "short")]


def test_languages_are_told_apart_and_noise_is_rejected(spark):
    pick = random.Random(2)
    vocabulary = {"en": "the of and thing with other there house".split(), "de": "der die und nicht schön straße auch haus".split()}
    rows = [(i, " ".join(pick.choices(vocabulary[lang], k=40)), lang) for i in range(200) for lang in [("en", "de")[i % 2]]]
    docs = spark.createDataFrame(rows, f"{DDL}, lang string")
    model = language.fit(docs)
    odd = [(900, None), (901, ""), (902, "12 34"), (903, "".join(pick.choices("qxzjkvw", k=300)))]
    asked = spark.createDataFrame([(i, text) for i, text, _ in rows] + odd, DDL)
    found = {r["doc_id"]: r for r in language.identified(asked, model).selectExpr("others.*", "lang_pred", "score", "rejected").collect()}
    assert all(found[i]["lang_pred"] == lang and not found[i]["rejected"] for i, _, lang in rows)
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (900, 901, 902))
    assert all(found[i]["rejected"] for i, _ in odd)
    probabilities = np.exp(model.entropies(np.arange(64) | (5 << 6), np.arange(65)) * -1).sum(axis=0)
    assert np.allclose(probabilities, 1, atol=1e-4), "the symbols after a context share one"


def test_toxic_words_are_learned_and_context_counts(spark):
    pick = random.Random(4)
    plain = "one two three four five six seven eight".split()
    rows, labels = [], []
    for i in range(300):
        own = pick.choices(plain, k=30)
        if i % 3 == 0:
            own[pick.randrange(30)] = "grumbler" + pick.choice("abc")
        rows.append((i, " ".join(own)))
        labels.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], DDL)
    grammar = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = toxicity.scored(docs, grammar).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 3 == 0 and r["doc_id"] < 900) for r in found if r["held_out"])
    assert all(0 <= r["score"] <= 1 for r in found)
    loud = toxicity.clause_score(["target", "insult"], [3.0, 3.0])
    plain_score = toxicity.clause_score(["other", "insult"], [3.0, 3.0])
    assert loud > plain_score > toxicity.clause_score(["negation", "insult"], [3.0, 3.0])
    assert plain_score > toxicity.clause_score(["report", "other", "insult"], [3.0, 3.0, 3.0])


def test_leaks_survive_replaced_words_and_case(spark):
    item = [f"Wörd{i}" for i in range(30)]
    changed = [w if i % 8 else "other" for i, w in enumerate(item)]
    texts = [" ".join(["x"] * 9 + item).upper(), "pre, " + "; ".join(changed), " ".join(item[:8]), "clean text", "", None]
    items = spark.createDataFrame([(5, " ".join(item)), (6, None), (7, "a b"), (5, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame([(i, t, "o") for i, t in enumerate(texts)], f"{DDL}, leaks string")
    found = {r["doc_id"]: r["items"] for r in decontaminate.marked(docs, items).selectExpr("others.doc_id", "leaks.item_id AS items").collect()}
    assert {i: set(x) for i, x in found.items()} == {0: {5}, 1: {5}, 2: set(), 3: set(), 4: set(), 5: set()}


def test_short_items_are_found_by_the_share_of_their_words(spark):
    """Every way to replace as many words as the share allows, and one more, for items of 1 to 14 words."""
    items, docs, want = [], [], {}
    for length in range(1, 15):
        item = [f"i{length}w{k}" for k in range(length)]
        items.append((length, " ".join(item)))
        least = min(12, -(-4 * length // 5))
        for changed in range(length - least + 2):
            for gone in combinations(range(length), min(changed, length)):
                text = ["so", *("other" if k in gone else w for k, w in enumerate(item)), "on"]
                want[len(docs)] = length if changed <= length - least else None
                docs.append((len(docs), " ".join(text)))
    docs_df = spark.createDataFrame(docs, DDL)
    rows = decontaminate.marked(docs_df, spark.createDataFrame(items, "item_id long, text string"))
    found = {r["doc_id"]: r["items"] for r in rows.selectExpr("others.doc_id", "leaks.item_id AS items").collect()}
    missed = {k: docs[k][1] for k, length in want.items() if length and found[k] != [length]}
    assert not missed
    # One word too many replaced: nothing, unless a stretch inside still holds the share of the item's words.
    assert not [docs[k][1] for k, length in want.items() if length is None and found[k]]


def test_the_overlap_is_the_best_of_all_stretches(spark):
    random_ = np.random.default_rng(7)
    for share in (0.8, 0.75, 1.0):
        for _ in range(300):
            equal = random_.random(random_.integers(0, 60)) > random_.uniform(0, 0.5)
            sums = np.concatenate([[0], np.cumsum(equal)])
            want = max(
                (int(sums[e] - sums[b]) for b in range(len(equal)) for e in range(b + 1, len(equal) + 1)
                 if sums[e] - sums[b] >= share * (e - b)), default=0,
            )
            same, at, length = decontaminate.overlap(equal, share)
            assert same == want == equal[at : at + length].sum() and same >= share * length
    item = [f"w{i}" for i in range(59)]
    text = " ".join(w if i < 14 or (i - 14) % 5 < 3 else "other" for i, w in enumerate(item))
    items = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    found = decontaminate.marked(spark.createDataFrame([(1, text)], DDL), items).selectExpr("leaks.item_id AS items").collect()
    assert [r["items"] for r in found] == [[5]], "14 exact words stand beside half-equal ones"
