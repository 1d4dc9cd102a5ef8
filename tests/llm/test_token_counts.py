"""Token counts against the library, text by text."""

from __future__ import annotations

import random
from collections import Counter as Tally

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bodega.llm import queries, token_counts

ODD = [*"ab'tsrevlmdSTMRE''  \n\t\r12é漢İΣſK,.!-'́ 　​’ß٣Ⅷ½\x1c\x85\x00😀", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def texts(number):
    pick = random.Random(3)
    return ["".join(pick.choices(ODD, k=pick.randint(0, 60))) for _ in range(number)]


def counted(own, table):
    raw = [text.encode() for text in own]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    return token_counts.counter(token_counts.VOCABULARY).counts(np.frombuffer(b"".join(raw), np.uint8), bounds, table).tolist()


def empty():
    return token_counts.Table(np.zeros(0, np.uint64), np.zeros(0, np.int64))


def test_odd_texts(library):
    own = texts(4000)
    assert counted(own, empty()) == [library(text) for text in own]


def test_every_code_point(library):
    every = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    own = ["".join(every[k : k + 40]) for k in range(0, len(every), 40)] + [f"a{c}{c}1{c}'s{c}b" for c in every[::97]]
    assert counted(own, empty()) == [library(text) for text in own]


def test_the_table_changes_no_count(library):
    own = texts(500)
    worker = token_counts.counter(token_counts.VOCABULARY)
    data = np.frombuffer(" ".join(own).encode(), np.uint8)
    codes, starts, ends, _, hashes = worker.hashed(data, np.array([0, len(data)]))
    keys, at = np.unique(hashes, return_index=True)
    table = token_counts.Table(keys, worker.lengths(worker.pieces(codes, starts[at], ends[at])))
    assert (table.find(hashes) >= 0).all() and (table.find(hashes + np.uint64(1)) < 0).sum() > len(hashes) * 0.9
    assert counted(own, table) == [library(text) for text in own]


def test_summaries_fall_short_by_a_bounded_count():
    pick = np.random.default_rng(1)
    room, true, parts = 50, Tally(), []
    for _ in range(20):
        values = (pick.zipf(1.3, 2000) % 5000 + 1).astype(np.uint64)
        true.update(values.tolist())
        keys, counts = np.unique(values, return_counts=True)
        parts.append(token_counts.merged([token_counts._EMPTY, (keys, counts, counts)], room))
    left = parts
    while len(left) > 1:
        left = [token_counts.merged(left[k : k + 3], room) for k in range(0, len(left), 3)]
    found = dict(zip(left[0][0].tolist(), left[0][1].tolist(), strict=True))
    bound = sum(true.values()) / room
    assert len(found) <= room
    assert all(true[k] - bound <= found.get(k, 0) <= true[k] for k in true)


def test_all_rows_of_a_table(spark, library, tmp_path):
    own = [*texts(300), None, "", "word " * 700_000, "a" * 100_000, "it's " * 3000]
    docs = spark.createDataFrame([(None if k % 50 == 0 else k // 2, text, "o", 1) for k, text in enumerate(own)], "doc_id long, text string, others string, n_bytes int")
    found = token_counts.counted(docs, keep=("doc_id", "others", "n_bytes")).selectExpr("others.*", "n_bytes AS size", "n_tokens").collect()
    want = [(None if k % 50 == 0 else k // 2, "o", 1, len((text or "").encode()), library(text)) for k, text in enumerate(own)]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op11_token_counts(spark, str(tmp_path)).filter(F.col("over_limit") != (F.col("n_tokens") > 2048))
    assert rows.isEmpty() and rows.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_an_empty_table(spark):
    assert token_counts.counted(spark.createDataFrame([], "doc_id long, text string")).collect() == []
