"""Phrase counts and scores against counting in Python, and the SQL twins over a whole folder."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from bodega.llm import automata, collocations, queries

DDL = "lang string, text string, score int"


def texts(number=500):
    pick = random.Random(2)
    vocabulary = ["the", "of", "a", "b\x00", "ab", "b", "é", "x" * 200, "漢", "A", "the", "Of"]
    blanks = [" ", " ", "  ", "\t", ". ", ",", "\n", " ", "\x0b", " "]
    rows = [
        (pick.choice(["en", None, "fr", "x/y"]), "".join(pick.choice(vocabulary) + pick.choice(blanks) for _ in range(pick.randint(0, 60))), 1)
        for _ in range(number)
    ]
    return [*rows, ("en", None, 1), ("en", "", 1), ("de", " .,", 1), ("one", "word " * 3000, 1), rows[0], rows[0]]


def counts(rows):
    found = Counter()
    for lang, text, _ in rows:
        lang = lang or "und"
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            found[lang, ()] += len(words)
            for k in range(1, 5):
                for at in range(len(words) - k + 1):
                    found[lang, tuple(words[at : at + k])] += 1
    return found


def ranked(rows, least, top):
    f = counts(rows)
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    kept = {}
    for (lang, words), a in candidates.items():
        inside = [
            b for (other, longer), b in candidates.items()
            if other == lang and len(longer) > len(words) and any(longer[k : k + len(words)] == words for k in range(len(longer)))
        ]
        if any(100 * b >= 80 * a for b in inside):
            continue
        cuts = [(2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        kept.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    for lang, found in kept.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, f[lang, ()], -score


@pytest.mark.parametrize("size, span, fan", [(500, 300, 256), (100_000, 1000, 256), (300, 64, 4)])
def test_counts_of_shards_ranges_and_groups_of_ranges(spark, size, span, fan):
    rows = texts()
    found = collocations.counts(spark.createDataFrame(rows, DDL).repartition(5), 5, size, span, fan).collect()
    assert len(found) == len({(r.lang, r.phrase) for r in found})
    want = {key: n for key, n in counts(rows).items() if n >= 5 or (not key[1] and n)}
    assert {(r.lang, tuple(r.phrase.split(" ")) if r.words else ()): r.f for r in found} == want


@pytest.mark.parametrize("top", [7, 2000])
def test_scores_and_ranks(spark, top):
    rows = texts(200)
    found = collocations.collocations(spark.createDataFrame(rows, DDL), least=6, top=top).collect()
    assert sorted(map(tuple, found)) == sorted(ranked(rows, 6, top))


def test_products_beyond_64_bits(spark):
    big = 3 * 10**17
    rows = [("en", 0, "", big), ("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 2)]
    (found,) = collocations.scored(spark.createDataFrame(rows, "lang string, words int, phrase string, f long")).collect()
    assert found.score == 2_000_000 * (big - 2) // (2 * big - 1)


def test_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], DDL)).collect() == []


def test_an_automaton_holds_its_sequences_and_shares_states():
    pick = np.random.default_rng(4)
    words = pa.array(sorted({f"w{k}".encode() for k in range(60)}), pa.large_binary())
    rows = pick.integers(1, 8, (4000, 5)).astype(np.int32)
    rows[:, 0] %= 2
    for row in rows:
        row[pick.integers(2, 6) :] = 0
    found = automata.counted([b"de", b"en"], words, rows)
    want = Counter(map(tuple, rows.tolist()))
    assert list(map(tuple, found.rows.tolist())) == sorted(want)
    assert found.counts.tolist() == [want[k] for k in sorted(want)]
    back = automata.read(automata.written(found))
    assert (back.rows == found.rows).all() and (back.counts == found.counts).all() and back.words.equals(words)
    wide = automata.Sequences([b"de", b"en"], pa.array([b"%06d" % k for k in range(70_000)], pa.large_binary()), found.rows, found.counts)
    twice = automata.united([wide, wide])
    assert (twice.counts == 2 * found.counts).all() and (twice.rows[:, 1:] == found.rows[:, 1:]).all()
    keys = [found.key(k) for k in (0, 17, len(found.rows) - 1)]
    assert found.lower_bounds(keys).tolist() == [0, 17, len(found.rows) - 1]
    cut = found.slice(10, 300)
    assert [cut.key(k) for k in range(290)] == [found.key(k) for k in range(10, 300)]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_the_sql_twin_gives_the_same_rows(spark, name):
    folder = "/root/testdata/sf0.001"
    df = queries.queries()[name](spark, folder)
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    answer = connection.execute(queries.oracle_sql()[name])
    columns = [column[0] for column in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, answer.fetchall()))
