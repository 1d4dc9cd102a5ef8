"""Repeated windows of words and bytes against counting every window."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from bodega.llm import substrings, suffixes, windows
from bodega.llm.arrays import BYTE_VALUES, span_hashes

DDL = "doc_id long, text string, others string, k1 int"


def rows():
    pick = random.Random(3)
    base = [pick.choice(["a", "b", "c", "d", "é", "x1", "yy", "zzz"]) for _ in range(400)]
    fixed = [(None, None), (1, ""), (2, " "), (2, "a b"), (3, " ".join(base)), (3, " ".join(base)), (99, "a " * 200)]
    noisy = [
        (i, " ".join(base[pick.randint(0, 300) :][: pick.randint(5, 120)] + pick.choices("abcd", k=30))) for i in range(4, 40)
    ]
    return [(*row, "x", 1) for row in fixed + noisy]


def expected(units: list, join: bytes, size: int):
    seen = Counter(tuple(u[i : i + size]) for u in units for i in range(len(u) - size + 1))
    for own in units:
        gone = [False] * len(own)
        for i in range(len(own) - size + 1):
            if seen[tuple(own[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = [u for u, g in zip(own, gone, strict=True) if not g]
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        yield len(own), sum(gone), runs, hashlib.sha256(join.join(kept)).hexdigest()


@pytest.mark.parametrize("hot", [1, 256])
def test_words(spark, monkeypatch, hot):
    monkeypatch.setattr(windows, "HOT", hot)
    found = substrings.remove_repeats(spark.createDataFrame(rows(), DDL), 6, 2)
    found = found.selectExpr("others.doc_id", "n_words", "n_removed", "sha2(kept, 256)", "others.k1")
    want = expected([(text or "").encode().split() for _, text, *_ in rows()], b" ", 6)
    want = [(row[0], n, removed, kept, 1) for row, (n, removed, _, kept) in zip(rows(), want, strict=True)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("hot", [1, 256])
def test_bytes(spark, monkeypatch, hot):
    monkeypatch.setattr(windows, "HOT", hot)
    found = suffixes.remove_repeats(spark.createDataFrame(rows(), DDL), 20, 5)
    found = found.selectExpr("others.doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)")
    texts = [[bytes([b]) for b in (text or "").encode()] for _, text, *_ in rows()]
    want = [(row[0], *found) for row, found in zip(rows(), expected(texts, b"", 20), strict=True)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], DDL)
    assert substrings.remove_repeats(docs).count() == 0 and suffixes.remove_repeats(docs).count() == 0


@pytest.mark.parametrize("kind", ["words", "bytes"])
def test_a_passage_in_many_surroundings_stays_in_bounded_buckets(spark, monkeypatch, kind):
    monkeypatch.setattr(windows, "CHUNK_BYTES", 4096)
    most = spark.sparkContext.accumulator(0)

    def watched(make):
        def made(size):
            solve = make(size)

            def counted(texts, keys, places):
                most.add(max(0, sum(map(len, texts)) - 3 * 4096 - 1000))
                return solve(texts, keys, places)

            return counted

        return made

    module = substrings if kind == "words" else suffixes
    monkeypatch.setattr(module, "_bucket", watched(module._bucket))
    pick = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(12))
    around = [" ".join(f"n{pick.randrange(10**6)}" for _ in range(14)) for _ in range(4000)]
    texts = [f"{around[2 * i]} {passage} {around[2 * i + 1]}" for i in range(2000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    if kind == "words":
        found = substrings.remove_repeats(docs, 10, 3).selectExpr("others.doc_id", "n_words", "n_removed", "sha2(kept, 256)")
        want = [(n, gone, kept) for n, gone, _, kept in expected([t.encode().split() for t in texts], b" ", 10)]
    else:
        found = suffixes.remove_repeats(docs, 30, 8).selectExpr("others.doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)")
        want = list(expected([[bytes([b]) for b in t.encode()] for t in texts], b"", 30))
    assert sorted(map(tuple, found.collect())) == [(i, *own) for i, own in enumerate(want)]
    assert most.value == 0, "a bucket went over its bound"


def removed(texts: list[bytes], size: int) -> list[bytes]:
    """What is left of byte texts, every window counted by its 64-bit hash."""
    hashes = []
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        at = np.arange(max(0, len(data) - size + 1))
        hashes.append(span_hashes(BYTE_VALUES[data], at, at + size) if len(at) else at.astype(np.uint64))
    values, counts = np.unique(np.concatenate(hashes), return_counts=True)
    again = values[counts > 1]
    left = []
    for text, own in zip(texts, hashes, strict=True):
        steps = np.zeros(len(text) + 1, np.int64)
        hit = np.flatnonzero(np.isin(own, again))
        np.add.at(steps, hit, 1)
        np.add.at(steps, hit + size, -1)
        gone = np.cumsum(steps[:-1]) > 0
        left.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
    return left


def test_long_texts_of_little_and_of_much_variety(spark):
    """Parts of a long text, periods of one, two and seven letters, and copies that lie across the parts."""
    pick = np.random.default_rng(2)
    noise = (pick.integers(0, 26, 2_300_000).astype(np.uint8) + 97).tobytes()
    step = windows.PART
    copied = noise[step - 700 : step + 700]
    texts = [b"a" * 2_500_000, b"ab" * 700_000, b"abcdefg" * 300_000 + b"x", noise, b"z" * 50 + copied, b"a" * 399, b"a" * 400]
    docs = spark.createDataFrame([(k, text.decode()) for k, text in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(docs.repartition(4)).selectExpr("others.doc_id", "kept").collect()}
    want = removed(texts, suffixes.LENGTH)
    assert [len(found[k]) for k in range(len(texts))] == [len(w) for w in want]
    assert [found[k] for k in range(len(texts))] == want and len(want[4]) == 50


def test_long_texts_of_one_word(spark):
    texts = ["word " * 2_000_000, "one two " * 600_000, " ".join(str(k) for k in range(1_200_000)), " ".join(str(k) for k in range(1_048_500, 1_048_700)), "word " * 35]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = substrings.remove_repeats(docs.repartition(3)).selectExpr("others.doc_id", "n_words", "n_removed", "kept").collect()
    found = {r.doc_id: (r.n_words, r.n_removed, len(r.kept.split())) for r in rows}
    assert found == {0: (2_000_000,) * 2 + (0,), 1: (1_200_000,) * 2 + (0,), 2: (1_200_000, 200, 1_199_800), 3: (200, 200, 0), 4: (35, 35, 0)}


def test_runs_of_a_long_text_of_one_letter_are_few_and_small():
    """20 MB: what a task holds of it at a time stays below a bound that does not depend on its length."""
    units = windows.Bytes(suffixes.LENGTH, suffixes.GRAM)
    data = np.full(20_000_000, 97, np.uint8)
    tracemalloc.start()
    rows = total = 0
    for _, part, bounds in units.parts(data, np.array([0, len(data)]), windows.PART):
        found = windows.runs(units, part, bounds)
        rows += len(found[0])
        total += int((found[2] * found[5]).sum())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == len(data) - suffixes.LENGTH + 1, "every window is in one run"
    assert rows < 1000 and peak < 300 << 20
