"""The whole pipeline against its stages in plain Python; the language model's own decisions are taken as given."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from bodega.llm import decontaminate, language

DDL = "doc_id long, text string, lang string, source string, n_chars long, _text string, kept int"
WORDS = {"en": "the of and thing with other there house about water", "de": "der die und nicht schön straße auch haus wasser über"}


def fixture():
    pick = random.Random(8)
    vocabulary = {lang: [*own.split(), *("".join(pick.choices("abdeghilmnorstu", k=pick.randint(3, 8))) for _ in range(400))] for lang, own in WORDS.items()}

    def prose(lang, n):
        return pick.choices(vocabulary[lang], k=n)

    items = [(1, " ".join(prose("en", 30))), (2, " ".join(prose("de", 8))), (3, None), (4, " ".join(prose("en", 60)))]
    passage = prose("en", 60)
    texts = []
    for k in range(120):
        lang = ("en", "de")[k % 2]
        words = prose(lang, pick.randint(1, 120))
        if k % 10 == 0:
            words = words[:20] + passage + words[20:]
        if k % 15 == 7:
            words += items[k % 2][1].split()
        texts.append((lang, " ".join(words)))
    for k in range(0, 60, 4):
        lang, text = texts[k]
        words = text.split()
        texts.append((lang, text.upper() if k % 8 else "  ".join([*words, "extra"])))
    texts += [("en", None), ("en", ""), ("en", "12 34"), ("de", " ".join(prose("de", 3000))), ("en", "x <|endoftext|> the water and the house")]
    rows = [(k, text, lang, f"s{k % 3}", len(text or ""), "keep me", 9) for k, (lang, text) in enumerate(texts)]
    pick.shuffle(rows)
    return rows, items


def one_of_near_copies(rows):
    sets = {}
    for row in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1] or "").encode())
        sets[row[0]] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {doc: doc for doc in sets}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [row for row in rows if find(row[0]) == row[0]]


def without_repeats(rows):
    split = {row[0]: (row[1] or "").encode().split() for row in rows}
    seen = {}
    for words in split.values():
        for k in range(len(words) - 34):
            window = tuple(words[k : k + 35])
            seen[window] = seen.get(window, 0) + 1
    for row in rows:
        words = split[row[0]]
        gone = [False] * len(words)
        for k in range(len(words) - 34):
            if seen[tuple(words[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        text = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode() if any(gone) else row[1]
        yield (row[0], text, *row[2:])


def leaks(text, item):
    def words(value):
        return re.findall(rb"[A-Za-z0-9\x80-\xff]+", value.lower().encode())

    a, b = words(text or ""), words(item or "")
    needed = min(decontaminate.MATCHES, -(-4 * len(b) // 5))
    for shift in range(-len(b), len(a)):
        equal = [0 <= k + shift < len(a) and a[k + shift] == b[k] for k in range(len(b))]
        for begin in range(len(b)):
            same = 0
            for end in range(begin, len(b)):
                same += equal[end]
                inside = 0 <= begin + shift and end + shift < len(a)
                if inside and needed and same >= needed and 5 * same >= 4 * (end - begin + 1):
                    return True
    return False


def pieces(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in rows:
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 0]
        number = -(-len(ids) // 2048)
        first = len(ids) - (number - 1) * 2048
        for piece in range(number):
            start = 0 if piece == 0 else first + (piece - 1) * 2048
            own = ids[start : start + (first if piece == 0 else 2048)]
            yield row[0], piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items = fixture()
    where = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DDL).write.parquet(str(where / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(where / "benchmark.parquet"))
    return str(where)


def test_the_run_is_that_of_its_stages(spark, folder):
    rows, items = fixture()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = language.identified(docs, language.fit(docs)).filter("NOT rejected").selectExpr("others.doc_id").collect()
    left = [row for row in rows if row[0] in {r.doc_id for r in known}]
    assert len(rows) - 25 < len(left) < len(rows)
    left = one_of_near_copies(left)
    shorter = list(without_repeats(left))
    assert any(a[1] != b[1] for a, b in zip(left, shorter, strict=True))
    clean = [row for row in shorter if not any(leaks(row[1], item) for _, item in items)]
    assert 0 < len(shorter) - len(clean) < 30
    found = corpus_pipeline.run(spark, folder).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, found)) == sorted(pieces(clean))


def test_a_stage_hands_on_every_column_as_it_is(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    whole = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.dtypes == whole.dtypes, name
    assert {tuple(r) for r in docs.select("_text", "kept").distinct().collect()} == {("keep me", 9)}


def test_an_empty_table(spark, folder, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
