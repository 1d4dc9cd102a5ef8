"""Best-fit packing of token sequences by exact complements.

Lengths are at most ``capacity``, so the whole packing is decided on a histogram of at most ``capacity`` entries,
whatever the number of pieces. Longest first, a length looks for one, two or three lengths that fill its gap exactly,
and uses a combination as often as the counts allow; an index of the available sums says at once whether a gap can be
filled. What is left is packed best fit, longest first. Pieces then find their place by their rank among the pieces
of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bodega.llm.arrays import column, ranges, slices
from bodega.llm.shared import store, task_number
from bodega.llm.tokens import encoder, with_ends

CAPACITY = 2048
_PIECES = "doc_id {id_type}, piece int, start long, length long, ids_crc32 long, block int, place long"
_RESULT = "doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, `offset` long"


class Plan:
    """Which sequence and offset the pieces of each length get, in the order of their ranks."""

    def __init__(self) -> None:
        self.sequences = 0
        self.rows: list[tuple[int, int, int, int]] = []  # length, first rank, first sequence, offset
        self._used: dict[int, int] = {}

    def add(self, lengths: list[int], times: int) -> None:
        """``times`` sequences, each holding ``lengths``."""
        at = 0
        for length in lengths:
            rank = self._used.get(length, 0)
            self.rows.append((length, rank, self.sequences, at))
            self._used[length] = rank + times
            at += length
        self.sequences += times


class Sums:
    """The available lengths as bits, so that pairs with a given sum are found by one shift."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts
        self.top = len(counts) - 1
        self.up = sum(1 << int(k) for k in np.flatnonzero(counts))
        self.down = sum(1 << (self.top - int(k)) for k in np.flatnonzero(counts))

    def take(self, lengths: list[int], times: int) -> None:
        for length in lengths:
            self.counts[length] -= times
            if not self.counts[length]:
                self.up &= ~(1 << length)
                self.down &= ~(1 << (self.top - length))

    def times(self, lengths: list[int]) -> int:
        """How often all of ``lengths`` can be taken together."""
        return min(int(self.counts[k]) // lengths.count(k) for k in lengths)

    def pair(self, total: int, with_lengths: list[int]) -> list[int] | None:
        """Two available lengths that add up to ``total``, the largest such one first."""
        shift = self.top - total
        both = self.up & (self.down >> shift if shift >= 0 else self.down << -shift)
        both &= (1 << total) - 1
        while both:
            large = both.bit_length() - 1
            small = total - large
            if small > large:
                return None
            if small and self.times([*with_lengths, large, small]):
                return [large, small]
            both &= ~(1 << large)
        return None

    def complement(self, length: int, gap: int) -> list[int] | None:
        """One, two or three available lengths that fill ``gap`` beside ``length``."""
        if self.counts[gap] and self.times([length, gap]):
            return [gap]
        if found := self.pair(gap, [length]):
            return found
        below = self.up & ((1 << gap) - 1)
        while below:
            first = below.bit_length() - 1
            if 3 * first < gap:
                return None
            rest = self.pair(gap - first, [length, first])
            if rest:
                return [first, *rest]
            below &= ~(1 << first)
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The packing of ``histogram`` (length to count) into sequences of ``capacity``."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        counts[length] = count
    result = Plan()
    if counts[capacity]:
        result.add([capacity], int(counts[capacity]))
        counts[capacity] = 0
    sums = Sums(counts)
    for length in range(capacity - 1, 0, -1):
        while counts[length] and (others := sums.complement(length, capacity - length)):
            group = [length, *others]
            times = sums.times(group)
            result.add(group, times)
            sums.take(group, times)
    _best_fit(counts, capacity, result)
    return result


def _best_fit(counts: np.ndarray, capacity: int, result: Plan) -> None:
    """Pack what is left, longest first, each into the fullest sequences that have room; alike ones move together."""
    by_room: dict[int, list[tuple[list[int], int]]] = {}
    rooms = 0
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            fitting = rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                held, times = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, held, times = capacity, [], -(-left // (capacity // length))
            each = min(room // length, left)
            filled = min(times, left // each)
            if filled < times and held:
                by_room.setdefault(room, []).append((held, times - filled))
                rooms |= 1 << room
            by_room.setdefault(room - each * length, []).append(([*held, *[length] * each], filled))
            rooms |= 1 << (room - each * length)
            left -= filled * each
    for groups in by_room.values():
        for held, times in groups:
            result.add(held, times)


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document with the check sum of their ids, and their place among equal lengths of a task.

    The first piece of a long document holds what is left over; the others are full.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = task_number()
        seen = np.zeros(capacity + 1, np.int64)
        for rows, data, bounds in slices(batches, "text"):
            ids, bounds = with_ends(*encoder().encode(data, bounds))
            sizes = np.diff(bounds)
            number = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), number)
            piece = ranges(np.zeros(len(sizes), np.int64), number)
            first = sizes - (number - 1) * capacity
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[doc], capacity)
            wide = ids.astype("<u4")
            begin = bounds[doc] + start
            sums = [zlib.crc32(wide[b : b + n]) for b, n in zip(begin, length, strict=True)]
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            place = np.empty(len(length), np.int64)
            place[order] = np.arange(len(length)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.record_batch(
                {
                    "doc_id": column(rows, "doc_id").take(pa.array(doc)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                    "block": pa.array(np.full(len(doc), block), pa.int32()),
                    "place": pa.array(place, pa.int64()),
                }
            )

    chosen = docs.select("doc_id", F.col("text").cast("string"))
    return chosen.mapInArrow(cut, _PIECES.format(id_type=docs.schema["doc_id"].dataType.simpleString()))


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its ids' check sum, sequence and offset there.

    A null or empty text has one piece of length 1, the end mark. Rows with equal ids or texts are packed each on
    their own; a null id stays null. An empty table gives no rows; other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    stored = store(pieces(docs, capacity), "pieces")
    counted = store(stored.groupBy("block", "length").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {row["length"]: row["n"] for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = sorted(plan(histogram, capacity).rows)
    table = np.array(rows, np.int64).reshape(-1, 4)
    lookup = spark.sparkContext.broadcast(table)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_rows = lookup.value
        by_length = np.searchsorted(plan_rows[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length = column(batch, "length").to_numpy()
            rank = column(batch, "rank").to_numpy()
            order = np.lexsort((rank, length))
            found = np.empty(len(length), np.int64)
            for k in np.unique(length):
                mine = order[np.searchsorted(length[order], k) : np.searchsorted(length[order], k, "right")]
                begin, end = by_length[k], by_length[k + 1]
                found[mine] = begin + np.searchsorted(plan_rows[begin:end, 1], rank[mine], "right") - 1
            sequence = plan_rows[found, 2] + rank - plan_rows[found, 1]
            kept = [column(batch, name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch(
                [*kept, pa.array(sequence), pa.array(plan_rows[found, 3])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = stored.join(offsets, ["block", "length"]).withColumn("rank", F.col("skip") + F.col("place"))
    return ranked.mapInArrow(placed, _RESULT.format(id_type=docs.schema["doc_id"].dataType.simpleString()))
