"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bodega.llm import (
    collocations,
    decontaminate,
    embeddings,
    jaccard,
    language,
    merkle,
    packing,
    substrings,
    suffixes,
    token_counts,
    toxicity,
    training_order,
    twins,
    warc,
)
from bodega.llm.shared import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op6_training_order(spark: SparkSession, folder: str) -> DataFrame:
    return training_order.order(spark, _table(spark, folder, "documents"))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op1_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = embeddings.near_duplicates(_table(spark, folder, "embeddings"))
    # Rows that repeat the kept id count as kept here; the operator keeps one of them.
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("kept")))


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.classes(_table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, _table(spark, folder, "labels")))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    rows = language.identified(docs.select("doc_id", "text"), language.fit(docs))
    held = language.held_out(F.col("others.doc_id")).alias("held_out")
    return rows.select("others.doc_id", held, "lang_pred", "score")


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = substrings.remove_repeats(_table(spark, folder, "documents"))
    return rows.select("others.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = suffixes.remove_repeats(_table(spark, folder, "documents"))
    return rows.select("others.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    rows = decontaminate.marked(docs, _table(spark, folder, "benchmark"))
    return rows.select(
        "others.doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("long").alias("n_items"),
        F.col("leaks.item_id").alias("item_ids"),
        F.array_max("leaks.matches").alias("matches"),
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    parts = warc.write(_table(spark, folder, "pages"), scratch_path(spark, "warc"))
    return warc.read(parts).drop("html", "url")


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = token_counts.counted(_table(spark, folder, "documents"))
    over = (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit")
    return rows.select("others.doc_id", "n_bytes", "n_tokens", over)


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select(*merkle.FIELDS)
    fields = {name: F.col(name) for name in merkle.FIELDS}
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    lowered = fields | {"text": F.translate("text", upper, upper.lower())}
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    tampered = F.when(hit, merkle.digest(list(lowered.values()))).alias("tampered")
    rows = merkle.manifest(docs, merkle.digest(list(fields.values())), keep=[F.col("doc_id"), tampered])
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("others.tampered", "leaf"), F.col("path")))
    return rows.select(
        "others.doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    found = (
        op1_embedding_near_dedup,
        op2_ngram_jaccard_join,
        op3_toxicity,
        op4_language_id,
        op5_substring_dedup,
        op6_training_order,
        op7_best_fit_packing,
        op8_suffix_dedup,
        op9_benchmark_decontamination,
        op10_warc,
        op11_token_counts,
        op12_merkle_manifest,
        op13_phrase_collocations,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_substring_dedup": twins.SUBSTRING_DEDUP,
        "op10_warc": twins.WARC,
        "op12_merkle_manifest": twins.MERKLE_MANIFEST,
        "op13_phrase_collocations": twins.PHRASE_COLLOCATIONS,
    }
