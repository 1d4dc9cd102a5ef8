"""The training-data pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage works on all rows that the one before has kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bodega.llm import decontaminate, jaccard, language, packing, substrings
from bodega.llm.shared import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that no learned language fits, or that have no letters."""
    return language.identified(docs, language.fit(docs)).filter("NOT rejected").select("others.*")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row with the smallest id stays; every row without words stays too."""
    columns = [F.col(f"`{name}`") for name in docs.columns]
    rows = docs.select(F.struct(*columns).alias("others"), *jaccard.keyed(docs))
    rows = rows.join(jaccard.representatives(docs), ["doc_id", "x"])
    # Rows of one id and text are repeats, but not those without words: each of them has a number of its own.
    rows = rows.withColumn("own", F.when(F.col("wordless"), F.monotonically_increasing_id()))
    order = [F.col(f"others.`{name}`") for name in docs.columns]
    place = F.row_number().over(Window.partitionBy("doc_id", "x", "text", "own").orderBy(*order))
    return rows.withColumn("place", place).filter("place = 1").select("others.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under a repeated window go; a text that loses none stays as it is, one that loses some has single blanks."""
    whole = "whole_text"
    while whole in map(str.lower, docs.columns):
        whole += "_"
    rows = substrings.remove_repeats(docs.withColumn(whole, F.col("text")))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(f"others.`{whole}`"))
    columns = {name: F.col(f"others.`{name}`") for name in docs.columns if name != "text"}
    columns["text"] = text
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(columns["n_chars"])
    return rows.select(*[columns[name].cast(docs.schema[name].dataType).alias(name) for name in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that overlap a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.marked(docs, items).filter(F.size("leaks") == 0).select("others.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left and their places in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Models, hashes of positions and token ids are out of SQL's reach; tests hold the operators, not yet the whole run, against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
