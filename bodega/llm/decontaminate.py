"""Benchmark decontamination by spaced-seed hashing.

A seed is a mask over consecutive words; words at its gaps may differ. All seeds of the benchmark items are hashed,
every position of a text is looked up under every mask, and each hit names an item and an alignment. Along the
alignment, the stretch with most equal words decides, among those where they make up the share.

Masks go by the length of an item. Under ``SHORT`` words the share leaves two words at most to differ, so three equal words in
a row, or two on both sides of a gap, are always there; under five words an item has to be there as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm.arrays import BYTE_VALUES, NO_LETTER, U64, column, mixed, slices, span_hashes, words

MASKS = ("1101011011", "11100101101", "1011010111", "11011")
SHORT_MASKS = ("111", "11011")
SHORT = 15
WHOLE = 5
MATCHES = 12
SHARE = 0.8
BLOCK_BYTES = 32 << 20
_FILTER = 1 << 22
_LEAK = "array<struct<item_id: long, matches: int, first_word: int, words: int>>"


def _hashed(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(data, bounds, NO_LETTER)
    return span_hashes(BYTE_VALUES[data], starts, ends), first


def seeds(hashes: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The seed hash at every position where the mask fits."""
    n = max(0, len(hashes) - len(mask) + 1)
    total = np.full(n, number + 1, U64)
    for k, sign in enumerate(mask):
        if sign == "1":
            total = mixed(total) + hashes[k : k + n]
    return mixed(total)


def masks_for(length: int) -> Iterator[tuple[int, str]]:
    """The numbered masks of an item of ``length`` words; a number stands for one mask."""
    every = [*MASKS, *SHORT_MASKS, *("1" * n for n in range(1, WHOLE))]
    wanted = MASKS if length >= SHORT else SHORT_MASKS if length >= WHOLE else ["1" * length]
    yield from ((number, mask) for number, mask in enumerate(every) if mask in wanted)


class Benchmark:
    """Seeds of a block of items, ready to be looked up."""

    def __init__(self, ids: list[int | None], texts: list[str | None]) -> None:
        self.ids, self.hashes = ids, []
        found, item, place = [], [], []
        self.masks: dict[int, str] = {}
        for number, text in enumerate(texts):
            data = np.frombuffer(pc.utf8_lower(pa.scalar(text or "")).as_py().encode(), np.uint8)
            hashes, _ = _hashed(data, np.array([0, len(data)]))
            self.hashes.append(hashes)
            for k, mask in masks_for(len(hashes)):
                self.masks[k] = mask
                own = seeds(hashes, mask, k)
                found.append(own)
                item.append(np.full(len(own), number))
                place.append(np.arange(len(own)))
        keys = np.concatenate([*found, np.zeros(0, U64)])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.item = np.concatenate([*item, np.zeros(0, np.int64)]).astype(np.int64)[order]
        self.place = np.concatenate([*place, np.zeros(0, np.int64)]).astype(np.int64)[order]
        self.filter = np.zeros(_FILTER, bool)
        self.filter[(self.keys & U64(_FILTER - 1)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(position, item, place in the item) of every seed of ``hashes`` that an item has."""
        for k, mask in self.masks.items():
            own = seeds(hashes, mask, k)
            likely = np.flatnonzero(self.filter[(own & U64(_FILTER - 1)).astype(np.int64)])
            begin = np.searchsorted(self.keys, own[likely])
            end = np.searchsorted(self.keys, own[likely], "right")
            for position, b, e in zip(likely.tolist(), begin.tolist(), end.tolist(), strict=True):
                for at in range(b, e):
                    yield position, int(self.item[at]), int(self.place[at])


def overlap(equal: np.ndarray, share: float) -> tuple[int, int, int]:
    """The stretch with most equal words among those where they make up ``share``, the shortest of such.

    Gives its matches, begin and length. With an equal word worth 1 - share and another -share, in whole numbers, a
    stretch will do when its sum is not negative; for each end the longest such stretch has most equal words.
    """
    exact = Fraction(str(share))
    sums = np.zeros(len(equal) + 1, np.int64)
    np.cumsum(np.where(equal, exact.denominator - exact.numerator, -exact.numerator), out=sums[1:])
    begin = np.searchsorted(-np.minimum.accumulate(sums), -sums)
    before = np.concatenate([[0], np.cumsum(equal)])
    same = before - before[begin]
    most = int(same.max())
    if not most:
        return 0, 0, 0
    places = np.flatnonzero(equal)
    first = before[begin[same == most]]
    lengths = places[first + most - 1] - places[first] + 1
    best = int(np.argmin(lengths))
    return most, int(places[first[best]]), int(lengths[best])


def _leaks(benchmark: Benchmark, hashes: np.ndarray, first: np.ndarray, matches: int, share: float) -> dict[int, dict]:
    """Per text of a slice, the overlaps with items that are long and equal enough; one for each item."""
    found: dict[int, dict[int, tuple]] = {}
    seen = set()
    for position, item, place in benchmark.hits(hashes):
        text = int(np.searchsorted(first, position, "right")) - 1
        shift = position - place
        if (text, item, shift) in seen:
            continue
        seen.add((text, item, shift))
        own = benchmark.hashes[item]
        needed = min(matches, math.ceil(Fraction(str(share)) * len(own)))
        begin, end = max(first[text], shift), min(first[text + 1], shift + len(own))
        equal = hashes[begin:end] == own[begin - shift : end - shift]
        same, at, length = overlap(equal, share)
        if same >= needed and same > found.get(text, {}).get(item, (0,))[0]:
            found.setdefault(text, {})[item] = (same, int(begin - first[text]) + at, length)
    return found


def marked(docs: DataFrame, benchmark: DataFrame, matches: int = MATCHES, share: float = SHARE) -> DataFrame:
    """Rows of ``docs`` as (others: all columns, leaks): the benchmark items that each text overlaps.

    Words are runs of letters and digits in lower case. A leak is a stretch along one alignment with at least
    ``matches`` equal words that make up ``share`` of it; of an item with fewer words, the share of its words, which under
    five words is the whole item. A null or empty text or item has no words and matches nothing. The benchmark is taken in blocks of ``BLOCK_BYTES``, each sent to
    the tasks whole, so that its size sets the number of passes and not the memory; repeated items are found each.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-volume // BLOCK_BYTES) or 1
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("others"),
        F.lit(None).cast(_LEAK).alias("leaks"),
    )
    leak_type = rows.schema["leaks"].dataType
    for number in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        shared = spark.sparkContext.broadcast(([r["item_id"] for r in block], [r["text"] for r in block]))
        rows = rows.mapInArrow(_search(shared, matches, share), rows.schema)
    return rows.select("others", F.coalesce("leaks", F.array().cast(leak_type)).alias("leaks"))


def _search(shared, matches: int, share: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = Benchmark(*shared.value)
        for batch in batches:
            texts = pc.utf8_lower(column(batch, "others").field("text").cast(pa.string()))
            work = pa.RecordBatch.from_arrays([*batch.columns, texts], names=["others", "leaks", "_text"])
            for rows, data, bounds in slices([work], "_text"):
                hashes, first = _hashed(data, bounds)
                found = _leaks(benchmark, hashes, first, matches, share)
                leaks = column(rows, "leaks").to_pylist()
                for text, items in found.items():
                    leaks[text] = [*(leaks[text] or []), *(
                        {"item_id": benchmark.ids[i], "matches": m, "first_word": at, "words": n}
                        for i, (m, at, n) in sorted(items.items())
                    )]
                yield pa.record_batch(
                    [column(rows, "others"), pa.array(leaks, rows.schema.field("leaks").type)], names=["others", "leaks"]
                )

    return search
