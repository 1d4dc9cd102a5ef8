"""The Merkle manifest against a tree built node by node."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from bodega.llm import merkle, queries

DDL = "doc_id long, source string, lang string, n_chars int, text string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row) -> str:
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """The root, and for each leaf its siblings by level as (left, right)."""
    paths, nodes, below = [[] for _ in leaves], list(leaves), [[k] for k in range(len(leaves))]
    while len(nodes) > 1:
        parents, under = [], []
        for begin in range(0, len(nodes), 16):
            run = nodes[begin : begin + 16]
            for k in range(len(run)):
                for leaf in below[begin + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            parents.append(digest("".join(run)))
            under.append([leaf for group in below[begin : begin + 16] for leaf in group])
        nodes, below = parents, under
    return nodes[0], paths


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {name: tree([leaf_of(r) for r in groups[name]]) for name in names}
    root, upper = tree([trees[name][0] for name in names])
    for name, above in zip(names, upper, strict=True):
        subroot, paths = trees[name]
        for row, path in zip(groups[name], paths, strict=True):
            whole = path + above
            leaf = node = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = leaf_of((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for left, right in whole:
                node = digest(left + node + right)
            yield row[0], leaf, subroot, root, digest("".join(a + b for a, b in whole)), node, node == root


def asked(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, DDL).withColumns({"leaf": F.lit("x"), "tree": F.lit(1), "place": F.lit(2)})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted(map(tuple, queries.op12_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)


def odd_rows():
    pick = random.Random(5)
    words = ["ÉA", "a", "Z", "", "x" * 300, "漢"]
    rows = [(k, pick.choice([None, "", "a", "B", "é", "s"]), pick.choice(["en", None]), pick.choice([None, k]), pick.choice(words)) for k in range(700)]
    rows += [(None, "a", None, None, None), (None, None, None, None, "T"), (5, "a", "en", 1, "T"), (5, "a", "en", 1, "T")]
    return rows + [(7, "a", "en", 1, "U"), (7, "a", "en", 1, "T"), (1, "alone", "en", 1, "T" * 2_000_000)]


def test_proofs_of_all_rows(spark, tmp_path):
    rows = odd_rows()
    assert asked(spark, tmp_path, rows) == sorted(expected(rows), key=repr)


@pytest.mark.parametrize("number", [1, 2, 16, 17, 4096, 4097])
def test_one_group_of_many_sizes(spark, tmp_path, number):
    rows = [(k, "s", "en", k, f"Text {k}") for k in range(number)]
    assert asked(spark, tmp_path, rows) == sorted(expected(rows), key=repr)


def test_more_groups_than_a_block_has_nodes(spark, tmp_path):
    rows = [(k, f"s{k % 4500}", "en", k, f"Text {k}") for k in range(5000)]
    assert asked(spark, tmp_path, rows) == sorted(expected(rows), key=repr)


def test_an_empty_table(spark, tmp_path):
    assert asked(spark, tmp_path, []) == []


def test_equal_rows_in_any_number_are_cut_through(spark):
    """A row that makes up most of a table is ranked by several tasks."""
    from bodega.llm.ranks import placed

    rows = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(5).alias("k"), F.lit("g").alias("g"))
    found = placed(rows, "g", ["k"], "ranks").withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r["place"] for r in found) == list(range(3000)) and {r["total"] for r in found} == {3000}
    assert [r["k"] for r in sorted(found, key=lambda r: r["place"])] == sorted(r["k"] for r in found)


def test_a_proof_holds_for_its_row_alone(spark):
    docs = spark.createDataFrame([(k, "s", "en", k, f"t{k}") for k in range(40)], DDL)
    rows = merkle.manifest(docs, merkle.digest([F.col(name) for name in merkle.FIELDS]))
    other = F.lit(leaf_of((99, "s", "en", 99, "t99")))
    ends = rows.select((merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("own"), (merkle.folded(other, F.col("path")) == F.col("root")).alias("other"))
    assert {tuple(r) for r in ends.collect()} == {(True, False)}
