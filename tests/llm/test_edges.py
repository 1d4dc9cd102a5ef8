"""Empty tables, nulls in every column, repeated rows and columns with names that the operators use themselves."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bodega.llm import decontaminate, embeddings, language, packing, queries, toxicity, training_order, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = ["others", "score", "leaks", "place", "shard", "lang_pred", "rejected", "length", "n", "key"]
EMPTY = {
    "documents": DOCS,
    "labels": "doc_id long, quality int, toxic int",
    "benchmark": "item_id long, text string",
    "pages": "page_id long, url string, html string",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name, ddl in EMPTY.items():
        spark.createDataFrame([], ddl).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_no_query_fails_on_empty_tables(spark, empty, name):
    assert queries.queries()[name](spark, empty).collect() == []


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, f"the house of number {k % 7} and the water there", ("en", None)[k % 5 == 0], "s", 1) for k in range(40)]
    rows += [(None, "the water and the house", "en", None, None), (None, None, None, None, None), (3, "", "en", "s", 0)]
    rows += [rows[1], rows[1], (1, "another text under the same id", "en", "s", 2)]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit(name).alias(name) for name in NAMES])


def ids(rows):
    return sorted((r.doc_id for r in rows), key=lambda k: (k is not None, k or 0))


def test_language_of_odd_rows(docs):
    rows = language.identified(docs, language.fit(docs)).selectExpr("others.*", "lang_pred AS found", "score AS sure").collect()
    assert ids(rows) == ids(docs.collect())
    assert all(r.found == ("und" if not r.text else "en") and 0 <= r.sure <= 1 for r in rows)
    assert all(r[name] == name for r in rows for name in NAMES)


def test_toxicity_of_odd_rows(spark, docs):
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(None, 1), (3, None), (3, 1), (3, 1)], "doc_id long, toxic int")
    rows = toxicity.scored(docs, toxicity.fit(docs, labels)).collect()
    assert ids(rows) == ids(docs.collect()) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_packing_and_order_of_odd_rows(spark, docs, tmp_path):
    packed = packing.pack(docs, 64).collect()
    assert ids(packed) == ids(docs.collect()), "short rows have one piece each, null and repeated ids too"
    back = training_order.read(training_order.write(docs, str(tmp_path / "order"), length=64), length=64).collect()
    assert sorted(r.slot for r in back) == list(range(docs.count()))


def test_leaks_of_odd_rows(spark, docs):
    items = spark.createDataFrame([(None, "the house of number 3 and"), (4, None), (5, ""), (6, "the house of number 3 and")], "item_id long, text string")
    rows = decontaminate.marked(docs, items.withColumn("leaks", F.lit(1))).selectExpr("others.doc_id", "others.text", "leaks.item_id AS items").collect()
    assert ids(rows) == ids(docs.collect())
    assert all(set(r["items"]) >= {None, 6} for r in rows if r.text and "number 3" in r.text)
    assert all(not r["items"] for r in rows if not r.text or "number" not in r.text)


def test_pages_of_odd_rows(spark, tmp_path):
    rows = [(1, None, "x" * 120), (1, None, "x" * 120), (None, "http://a.org/", None), (2, "", "x" * 120), (None, "b", "x" * 120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "first": F.lit(2), "size": F.lit(3)})
    found = warc.read(warc.write(pages, str(tmp_path / "warc"))).collect()
    assert sorted((r.record_type, r.refers_to or 0, r.payload_bytes) for r in found) == [
        ("response", 0, 0), ("response", 0, 120), ("response", 0, 120), ("revisit", 1, 120), ("revisit", 1, 120),
    ]


def test_vectors_of_odd_rows(spark):
    one, other = [1.0, 0.0, 0.5], [0.0, 1.0, 0.0]
    rows = [(1, one), (1, one), (2, one), (3, other), (None, other), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [float("nan"), 1.0, 0.0]), (8, [1.0, None, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({name: F.lit(name) for name in ("node", "digest", "n_links", "row")})
    found = embeddings.near_duplicates(table).collect()
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in found)
    assert got == [(0, 1, 3), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 1, 3), *((k, 0, k) for k in range(4, 9))]
    assert sum(r.kept for r in found if r.component_id == 1) == 1
