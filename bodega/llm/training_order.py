"""Training-order materialisation: a keyed permutation gives every sequence its place in fixed-stride shards.

A document's ids are cut into sequences of ``length`` ids. Sequence ``piece`` of document ``doc_id`` has the number
``(doc_id - smallest) * pieces_at_most + piece``; a Feistel network under the run's key, walked until it lands inside
the domain, permutes those numbers. Shards take equal ranges of the permuted numbers, so their order is the training
order, and a sequence's slot is its place in it. A record is 16 bytes of header and ``length`` ids of 2 bytes: slot
to file and byte is arithmetic, and a reader can resume anywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bodega.llm.arrays import U64, binary, column, mixed, ranges, slices
from bodega.llm.shared import bytes_of, open_input, published, scratch_path, store, task_count
from bodega.llm.tokens import encoder, with_ends

LENGTH = 512
KEY = 20_240_229
SHARD_BYTES = 64 << 20
_HEADER = np.dtype([("doc_id", "<i8"), ("piece", "<u4"), ("length", "<u4")])
_ROUNDS = 6
_WIDEST = 1 << 62
NO_ID = -(1 << 63)


def permuted(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """Each of ``numbers`` (below ``size``) under the keyed permutation of ``0 .. size-1``."""
    half = max(1, -(-max(1, (size - 1).bit_length()) // 2))
    mask = U64((1 << half) - 1)
    keys = mixed(np.arange(1, _ROUNDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(key))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> U64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mixed(right + k) & mask)
        return (left << U64(half)) | right

    result = once(numbers.astype(U64))
    outside = np.flatnonzero(result >= size)
    while len(outside):
        result[outside] = once(result[outside])
        outside = outside[result[outside] >= size]
    return result


def _record(length: int) -> np.dtype:
    return np.dtype([*_HEADER.descr, ("ids", "<u2", (length,))])


def write(docs: DataFrame, folder: str, length: int = LENGTH, key: int = KEY) -> DataFrame:
    """Write the shards under ``folder``; gives the manifest: shard, file, sequences and first slot.

    A null or empty text is one sequence, its end mark; short sequences are padded with the end mark. Rows with equal
    ids tie in the order and are told apart by their ids' check sum. Other columns are not looked at. An empty table
    writes nothing. A null id is stored as the smallest long.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    least, most, longest = chosen.agg(F.min("doc_id"), F.max("doc_id"), F.max(F.octet_length("text"))).first()
    least, most = least or 0, most or 0
    per_doc = -(-((longest or 0) + 1) // length)
    size = (most - least + 2) * per_doc
    shards = task_count(spark, bytes_of(chosen, "text"), SHARD_BYTES)
    folded = size > _WIDEST
    domain = _WIDEST if folded else size

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "text"):
            ids, bounds = with_ends(*encoder().encode(data, bounds))
            number = -(-np.diff(bounds) // length)
            doc = np.repeat(np.arange(len(number)), number)
            piece = ranges(np.zeros(len(number), np.int64), number)
            begin = bounds[doc] + piece * length
            end = np.minimum(begin + length, bounds[doc + 1])
            ids_column = column(rows, "doc_id")
            doc_id = ids_column.fill_null(least - 1 if not folded else NO_ID).to_numpy()[doc]
            place = (doc_id.astype(U64) - U64((least - 1) % (1 << 64))) * U64(per_doc) + piece.astype(U64)
            if folded:  # ids spread over more than the widest domain: the order ties where hashes do
                place = mixed(place) % U64(domain)
            order = permuted(place, domain, key)
            yield pa.record_batch(
                {
                    "shard": pa.array([int(x) * shards // domain for x in order], pa.int32()),
                    "place": pa.array(order.astype(np.int64)),
                    "doc_id": ids_column.fill_null(NO_ID).take(pa.array(doc)),
                    "piece": pa.array(piece, pa.int32()),
                    "ids": binary([ids[b:e].tobytes() for b, e in zip(begin, end, strict=True)]),
                }
            )

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _record(length)
        shard, records, file, held = None, 0, None, ExitStack()

        def finish() -> pa.RecordBatch:
            held.close()
            return pa.record_batch({"shard": [shard], "file": [name(shard)], "n": [records]}, schema=manifest_type)

        for batch in batches:
            numbers = column(batch, "shard").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)]])
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                if begin == end:
                    continue
                if shard != numbers[begin]:
                    if records:
                        yield finish()
                    shard, records = int(numbers[begin]), 0
                    file = held.enter_context(published(name(shard)))
                block = np.zeros(end - begin, kind)
                block["doc_id"] = column(batch, "doc_id").to_numpy()[begin:end]
                block["piece"] = column(batch, "piece").to_numpy()[begin:end]
                for k, ids in enumerate(column(batch, "ids").slice(begin, end - begin).to_pylist()):
                    found = np.frombuffer(ids, "<u2")
                    block["length"][k] = len(found)
                    block["ids"][k, : len(found)] = found
                file.write(block.tobytes())
                records += end - begin
        if records:
            yield finish()

    def name(shard: int) -> str:
        return f"{folder}/shard-{shard:08d}.bin"

    manifest_type = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n", pa.int64())])
    cut_rows = chosen.mapInArrow(cut, "shard int, place long, doc_id long, piece int, ids binary")
    # A shard is a range of permuted places, and each range is one task.
    dealt = cut_rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "place", F.crc32("ids"))
    written = store(dealt.mapInArrow(out, "shard int, file string, n long"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("first_slot", F.coalesce(F.sum("n").over(before), F.lit(0)))


def read(manifest: DataFrame, length: int = LENGTH, from_slot: int = 0) -> DataFrame:
    """The sequences in training order from ``from_slot`` on, each shard read from front to back."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _record(length)
        for batch in batches:
            for row in batch.to_pylist():
                skip = max(0, from_slot - row["first_slot"])
                with open_input(row["file"]) as file:
                    file.seek(skip * kind.itemsize)
                    while data := file.read(4096 * kind.itemsize):
                        records = np.frombuffer(data, kind)
                        slot = row["first_slot"] + skip + np.arange(len(records))
                        ids = [r["ids"][: r["length"]].tobytes() for r in records]
                        skip += len(records)
                        yield pa.record_batch(
                            {
                                "slot": pa.array(slot, pa.int64()),
                                "shard": pa.array(np.full(len(records), row["shard"]), pa.int32()),
                                "doc_id": pa.array(records["doc_id"].astype(np.int64)),
                                "piece": pa.array(records["piece"].astype(np.int32)),
                                "length": pa.array(records["length"].astype(np.int64)),
                                "ids": binary(ids),
                            }
                        )

    wanted = manifest.filter(F.col("first_slot") + F.col("n") > from_slot)
    return wanted.mapInArrow(back, "slot long, shard int, doc_id long, piece int, length long, ids binary")


def order(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write ``docs`` in training order and read the shards back: a row per sequence, ids as their check sum."""
    manifest = write(docs, scratch_path(spark, "training_order"))
    tasks = max(1, spark.sparkContext.defaultParallelism)
    back = read(store(manifest, "manifest").repartitionById(tasks, F.pmod("shard", F.lit(tasks))))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4")) for ids in column(batch, "ids").to_pylist()]
            names = ["slot", "shard", "doc_id", "piece", "length"]
            yield pa.record_batch(
                [*(column(batch, n) for n in names), pa.array(sums, pa.int64())], names=[*names, "ids_crc32"]
            )

    rows = back.mapInArrow(summed, "slot long, shard int, doc_id long, piece int, length long, ids_crc32 long")
    return rows.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
