"""Linked texts and vectors against comparing all pairs."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np

from bodega.llm import embeddings, jaccard
from bodega.llm.components import components


def roots(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (5, 6)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    want = roots({x for link in links for x in link}, links)
    assert {r["node"]: r["component"] for r in found.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_links_what_all_pairs_link(spark):
    pick = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = [pick.choices(words, k=pick.randint(3, 60)) for _ in range(30)]
    texts = {0: None, 1: "", 2: "a", 3: "A", 4: "a b", 5: " a  B\n"}
    for i in range(6, 300):
        own = list(pick.choice(base))
        for _ in range(pick.randint(0, 4)):
            own[pick.randrange(len(own))] = pick.choice(words)
        texts[i] = " ".join(own)

    def shingles(text):
        own = (text or "").lower().split()
        return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()

    sets = {i: shingles(text) for i, text in texts.items()}
    links = [
        (i, j) for i in sets for j in sets
        if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and sets[j]
    ]
    want = roots(sets, links)
    rows = [(i, text, 9) for i, text in texts.items()]
    found = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string, f int")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {i: (len(sets[i]), want[i]) for i in sets}
    assert jaccard.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_copies_too_far_from_the_hub_still_find_their_partners(spark):
    pick = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base)]
    for i in range(150):
        own = list(base)
        for at in pick.sample(range(100), pick.randint(1, 6)):
            own[at] = f"x{pick.randrange(3)}"
        texts.append(" ".join(own))
    sets = [{tuple(own[i : i + 5]) for i in range(len(own) - 4)} for own in (t.split() for t in texts)]
    links = [
        (i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    found = jaccard.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == roots(range(len(sets)), links)


def test_vectors_link_at_the_threshold(spark):
    random_ = np.random.default_rng(1)
    centres = random_.standard_normal((12, 24))
    near = [c + random_.standard_normal(24) * 0.15 for c in centres for _ in range(25)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([*near, *near[:5]])]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 24), (1003, [None] * 24), (1004, [float("nan")] * 24), (1005, [1.0])]
    found = embeddings.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")).collect()
    matrix = np.array([v for _, v in rows])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    close = matrix @ matrix.T >= 0.95
    np.fill_diagonal(close, False)
    wanted = int(close.sum())
    got = {r["vec_id"]: r["n_links"] for r in found}
    assert all(got[i] <= close[i].sum() for i in range(len(rows))), "nothing below the threshold"
    assert sum(got[i] for i in range(len(rows))) >= 0.98 * wanted > 0
    assert all(got[i] == 0 for i, _ in odd)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_copies_without_an_id_join_nothing_else(spark):
    one, two, three, four = (" ".join(f"{name}{i}" for i in range(30)) for name in "abcd")
    rows = [(1, one), (None, one), (2, two), (None, two), (None, three), (7, four), (7, two), (2, two)]
    rows += [(None, None), (None, ""), (8, "")]
    docs = spark.createDataFrame([(*row, "o") for row in rows], "doc_id long, text string, others string")
    found = jaccard.classes(docs).collect()
    got = sorted(((r["doc_id"], r["component_id"]) for r in found), key=str)
    want = [(1, 1), (None, 1), (2, 2), (None, 2), (None, None), (7, 7), (7, 2), (2, 2), (None, None), (None, None), (8, 8)]
    assert got == sorted(want, key=str)
    kept = corpus_pipeline.ngram_jaccard_join(spark, docs, "").collect()
    assert kept[0].asDict().keys() == {"doc_id", "text", "others"}
    stays = [(1, one), (2, two), (None, three), (7, four), (None, None), (None, ""), (8, "")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(stays, key=str)


def test_vectors_without_an_id_join_nothing_else(spark):
    axes = [[1.0 if i == k else 0.0 for i in range(8)] for k in range(3)]
    near = [1.0, 0.01, *[0.0] * 6]
    rows = [(1, axes[0]), (None, axes[0]), (5, near), (2, axes[1]), (None, axes[1]), (None, axes[2]), (None, axes[2]), (None, None)]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = sorted((tuple(r) for r in found), key=str)
    want = [(1, 2, 1, True), (None, 2, 1, False), (5, 2, 1, False), (2, 1, 2, True), (None, 1, 2, False)]
    want += [(None, 1, None, True), (None, 1, None, False), (None, 0, None, True)]
    assert got == sorted(want, key=str)
